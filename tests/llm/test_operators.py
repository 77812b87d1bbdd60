"""Each operator on a small table of awkward rows against a brute-force version, and on an empty one."""
import hashlib
import os
import re
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from faultline.llm import html_text, jaccard, lines, packing, preference, ring, rules, substrings, templates, wavelet  # noqa: E402
from faultline.llm.encode import Encoder  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id long, text string, lang string, source string, n_chars long, start long, shard int, label string"
BYTE, PLAIN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def spark():
    from faultline.session import get_session
    return get_session("local[4]", 4, app="faultline-tests")


@pytest.fixture(scope="module")
def rows():
    base = prose(1, 300)
    near = base.split()
    near[150] = "changed"
    shared = prose(2, 80)
    texts = [base, " ".join(near), base, None, "", "   \n\t ", "one two three", "One two THREE", "x" * 5000, prose(3, 6000), shared,
             prose(4, 40) + " " + shared + " " + prose(5, 40), prose(6, 10) + " " + shared, "é ü ñ ß’s it's\r\n\x0b 12.5% #a|b", "a b\nc d\na b\nc d\n\nz",
             "\n".join(prose(s, 9) for s in range(20, 40)), prose(9, 3) + "\n" + "\n".join(prose(s, 9) for s in range(22, 38)), " ".join(["again"] * 60)]
    out = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else "s", None, 1, 2, "x") for i, t in enumerate(texts)]
    return out + [(17, texts[17], None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def test_encoder_equals_library():
    odd = ["a\tb c", "  x\n\n y  ", " \n", "", "it's 's 'll", "¿qué? 12 34.5", "a b", "<|endoftext|> a", "x²y 1²", "ΣΑΣ ς", "éx", "\n\n\na", "_a_ b_", "a" * 500]
    for path, keeps in ((BYTE, True), (PLAIN, False)):
        enc = Encoder(path, keeps)
        want = [np.asarray(enc.tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in odd]
        assert enc.encode(odd) == want and enc.encode(odd) == want


def test_encoder_equals_fresh_library():
    from tokenizers import Tokenizer
    odd = ["hello <|endoftext|> a", "<|endoftext|>", "<|startoftext|>a b<|endoftext|>", "x\n<|endoftext|>\ny", "<|ENDOFTEXT|> é", "a <|endoftext| > b", "it’s <|endoftext|>é\u3000z", "plain text"]
    for path, keeps in ((BYTE, True), (PLAIN, False)):
        fresh = Tokenizer.from_file(path)
        want = [np.asarray(fresh.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in odd]
        assert Encoder(path, keeps).encode(odd) == want
    assert Encoder(BYTE, True).encode(odd[:1])[0] == np.array([31373, 220, 50256, 257], "<u4").tobytes()


def test_wavelet_shard_queries():
    ids = np.random.default_rng(0).integers(0, 50257, 70_000).astype(np.uint16)
    ids[::3] = 7
    s = wavelet.Shard(wavelet.build_shard([3, None], np.array([69_000, 1000]), ids, 16))
    assert s.doc_ids == [3, None] and (s.ids() == ids).all()
    for i in (0, 1, 32767, 32768, 69_999):
        v = int(ids[i])
        assert s.access(i) == v and s.rank(v, i) == int((ids[:i] == v).sum()) and s.select(v, s.rank(v, i)) == i
    assert s.count(7) == int((ids == 7).sum()) and s.count(1 << 20) == 0
    with pytest.raises(IndexError):
        s.select(7, s.count(7))


def test_wavelet_round_trip(docs, rows, empty):
    tok = Encoder(BYTE, True).tokenizer
    got = sorted(wavelet.read_documents(wavelet.write_shards(docs, BYTE, shard_tokens=3000)).collect(), key=lambda r: r.start)
    at = 0
    for r, row in zip(got, sorted(rows, key=lambda x: (x[0], x[1] or ""))):
        ids = tok.encode(row[1] or "", add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (row[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len(got) == len(rows)
    assert wavelet.read_documents(wavelet.write_shards(empty, BYTE)).count() == 0


def test_packing(docs, rows, empty):
    got = packing.pack_documents(docs, PLAIN, length=256).collect()
    tok = Encoder(PLAIN, False).tokenizer
    want = Counter()
    for row in rows:
        ids = np.array(tok.encode(row[1] or "", add_special_tokens=False).ids + [0], "<u4")
        want.update((row[0], i // 256, i, len(ids[i:i + 256]), zlib.crc32(ids[i:i + 256].tobytes())) for i in range(0, len(ids), 256))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= -(-sum(r.length for r in got) // 256) + 2
    assert packing.pack_documents(empty, PLAIN).count() == 0


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_jaccard_components(spark, docs, rows, empty):
    extra = [(100 + s, " ".join(w if i % (7 + s % 5) or i < 40 else f"{w}{s % 4}" for i, w in enumerate(prose(50, 200).split())), None, None, None, None, None, None) for s in range(30)]
    every = {r[0]: shingles(r[1]) for r in rows + extra}
    top = {d: d for d in every}
    links = [(a, b) for a in every for b in every if a < b and every[a] and 100 * len(every[a] & every[b]) >= 80 * len(every[a] | every[b])]
    for _ in every:
        for a, b in links:
            top[a] = top[b] = min(top[a], top[b])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs.unionByName(spark.createDataFrame(extra, DDL))).collect()}
    assert got == {d: (len(s), top[d]) for d, s in every.items()}
    assert jaccard.near_duplicates(empty).count() == 0


def test_tree_leaves_no_pair_out():
    rng = np.random.default_rng(3)
    at = rng.integers(0, 6, (150, jaccard.GROUPS)).astype(np.int32)
    at[75:] = at[:75]
    at[75:, 0] += 1
    n, label = at.sum(1), np.arange(150)
    got = {tuple(sorted(p)) for x, y in jaccard._open(np.arange(100), np.arange(100, 150), at, n, label) for p in zip(x.tolist(), y.tolist())}
    want = {(i, j) for i in range(100) for j in range(100, 150) if np.minimum(at[i], at[j]).sum() >= jaccard.least_overlap(n[i], n[j])}
    assert got == want and want


def test_tree_bounds_very_long_sets():
    s = np.arange(100_000, dtype=np.uint64)  # one group
    at = jaccard.points([s, s[:-1]]).astype(np.int32)
    got = [(x.tolist(), y.tolist()) for x, y in jaccard._open(np.array([0]), np.array([1]), at, np.array([100_000, 99_999]), np.arange(2))]
    assert at[0, 0] == 100_000 and got == [([0], [1])]


def test_substrings(docs, rows, empty):
    words = [(r[0], WORD.findall(r[1] or "")) for r in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - 49):
            key = tuple(w[i:i + 50])
            first[key] = min(first.get(key, d), d)
    want = Counter()
    for d, w in words:
        gone = {j for i in range(len(w) - 49) if first[tuple(w[i:i + 50])] < d for j in range(i, i + 50)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want[d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.dedup(docs).collect())
    assert got == want and sum(k[2] for k in want) > 300
    assert substrings.dedup(empty).count() == 0


def test_substrings_lengthened_prefix(docs, monkeypatch):
    usual = Counter(tuple(r) for r in substrings.dedup(docs).collect())
    monkeypatch.setattr(substrings, "SUBTREE", 1)
    assert Counter(tuple(r) for r in substrings.dedup(docs).collect()) == usual


def test_quality_rules(docs, rows, empty):
    got = Counter(tuple(r)[:7] for r in rules.judge(docs, ["doc_id"]).drop("n_echo_words", "kept").collect())
    want = Counter()
    for r in rows:
        x = r[1] or ""
        w, ls = WORD.findall(x), [s for s in x.split("\n") if WORD.search(s)]
        c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        want[r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(ls) - len(set(ls)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)] += 1
    assert got == want
    kept = rules.keep_documents(docs)
    assert kept.columns == docs.columns and not kept.where("doc_id in (3, 4, 17)").count()
    assert rules.judge(empty, ["doc_id"]).count() == 0 and rules.keep_documents(empty).count() == 0


def test_thresholds_drop_outliers_only(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(f"w{j % 40}x" * int(rng.integers(1, 3)) + f"{i}" for j in range(60)), "en", "s") for i in range(40)]
    rows.append((99, " ".join(f"w{j}***" for j in range(60)), "en", "s"))
    judged = {r.doc_id: r.kept for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), ["doc_id"]).collect()}
    assert not judged.pop(99) and all(judged.values())


def chunks_of(text):
    """(lines, body) of the chunks, from the definition."""
    ls = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:15], 16) % lines.MODULUS for x in ls]
    out, start = [], 0
    for i in range(len(ls)):
        r = 0
        for j in range(i - lines.WINDOW + 1, i + 1):
            r = (r * lines.FACTOR + (h[j] if j >= 0 else 0)) % lines.MODULUS
        if r % lines.DIVISOR == 0 or i == len(ls) - 1:
            out.append((i + 1 - start, "\n".join(ls[start:i + 1])))
            start = i + 1
    return out


def test_line_chunks(docs, rows, empty):
    seen, want = set(), {}
    for d, text in sorted({(r[0], r[1]) for r in rows if r[1] is not None}):
        own = chunks_of(text)
        gone = [(d, i) for i, (n, body) in enumerate(own) if n >= 2 and WORD.search(body) and body in seen or body in [x for _, x in own[:i]] and n >= 2 and WORD.search(body)]
        want[d] = (sum(own[i][0] for _, i in gone), "\n".join(body for i, (_, body) in enumerate(own) if (d, i) not in gone))
        seen |= {body for _, body in own}
    want[3] = (0, None)
    cut = lines.dedup_lines(docs)
    got = {r.doc_id: (r["__n_removed"], r.text) for r in cut.collect()}
    assert got == want and got[16][0] > 4  # the shared lines stand one line lower there
    assert cut.columns == docs.columns + ["__n_removed"] and lines.dedup_lines(empty).count() == 0


def runs_left(table):
    """doc_id -> the lines that stay, from the definition."""
    first, out = {}, {}
    for d, text in sorted(table):
        ls = text.split("\n")
        worded = [i for i, x in enumerate(ls) if WORD.search(x)]
        gone = set()
        for a, b in zip(worded, worded[1:]):
            at = first.setdefault((ls[a], ls[b]), (d, b))
            if at[0] < d or a > at[1]:
                gone.update(range(a, b + 1))
        out[d] = (len(gone), "\n".join(x for i, x in enumerate(ls) if i not in gone))
    return out


def test_line_runs(spark, docs, rows, empty):
    """Passages of 2 to 6 lines planted between foreign lines: every repetition goes, whatever its neighbours."""
    rng = np.random.default_rng(5)
    passages = [[prose(3000 + 10 * p + i, 6) for i in range(2 + p % 5)] for p in range(60)]
    table, planted = [], 0
    for d in range(200):
        own = [prose(5000 + 10 * d + i, 6) for i in range(6)]
        p = passages[int(rng.integers(60))] if d >= 60 else passages[d]
        at = int(rng.integers(1, 6))
        planted += len(p) if d >= 60 else 0
        table.append((1000 + d, "\n".join(own[:at] + p + own[at:])))
    table += [(2000, "q w\n\ne r\nq w\ne r"), (2001, "q w\ne r\n \nnew"), (2002, "q w\nq w\nq w"), (2003, "t\nt\nt\nt\nt")]
    every = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r["__n_removed"], r.text) for r in lines.dedup_runs(every).collect()}
    want = runs_left(table)
    assert got == want
    assert sum(n for d, (n, _) in got.items() if d < 2000) == planted
    assert {r.doc_id: (r["__n_removed"], r.text) for r in lines.dedup_chunks(every).collect()} == want
    chunked = sum(r["__n_removed"] for r in lines.dedup_lines(every).where("doc_id < 2000").collect())
    print(f"planted {planted} lines: runs {planted}, chunks {chunked}")
    assert chunked < planted
    cut = lines.dedup_runs(docs)
    assert cut.columns == docs.columns + ["__n_removed"] and lines.dedup_runs(empty).count() == 0
    own = {(r.doc_id, r.text) for r in cut.collect()}
    assert (3, None) in own and cut.count() == len(rows)


def test_chunks_remove_whole_runs(spark, docs, rows, empty):
    """Chunks and the runs at their edges together give the rule, whatever the boundaries; so does the SQL."""
    import duckdb
    rng = np.random.default_rng(11)
    table = []
    for d in range(300):  # few lines, so that copies, runs within a text and twin lines are frequent
        own = [str(rng.choice(["a", "b", "c d", "", " ", "e", "f g", "h", "i", "j"])) for _ in range(int(rng.integers(0, 9)))]
        foreign = [prose(9000 + 10 * d + i, 3) for i in range(3)]
        table.append((d, "\n".join(foreign[:d % 3] + own + foreign[d % 3:])))
    table += [(300 + k, "\n".join(prose(700 + i, 4) for i in range(40))) for k in range(20)]  # copies of several chunks
    table += [(320, "x\nx\nx\nx\nx"), (321, ""), (322, "one line"), (323, "x\n\nx\ny\nx\ny\nx"), (324, " \n\t")]
    every = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r["__n_removed"], r.text) for r in lines.dedup_chunks(every).collect()}
    assert got == runs_left(table) and got[310] == (40, "")
    with duckdb.connect() as db:
        import pandas as pd
        db.register("documents", pd.DataFrame(table, columns=["doc_id", "text"]))
        sql = db.execute(lines.RUNS_SQL.format(docs="documents") + " SELECT doc_id, n_removed, body FROM kept").fetchall()
    assert {d: (n, body) for d, n, body in sql} == got
    odd = docs.unionByName(spark.createDataFrame([(None, "a b\nc d", None, None, None, 1, 2, "x")], docs.schema))
    as_runs = sorted(map(str, lines.dedup_runs(odd).collect()))
    assert sorted(map(str, lines.dedup_chunks(odd).collect())) == as_runs and len(as_runs) == len(rows) + 1
    assert lines.dedup_chunks(empty).columns == docs.columns + ["__n_removed"] and lines.dedup_chunks(empty).count() == 0


def test_ring(docs, rows, empty, spark):
    got = ring.assign(docs).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == len(rows) and set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    by = {r[0]: (r[1] or "").encode() for r in rows}
    assert all((r.size, r.text_crc32) == (len(by[r.doc_id]) + 1, zlib.crc32(by[r.doc_id])) for r in got)
    assert ring.assign(empty).count() == 0
    # limited movement: with one shard more, about one row in 17 should move besides what overflows
    many = spark.range(4000).selectExpr("id AS doc_id", "string(id) AS text")
    a = {r.doc_id: r.shard for r in ring.assign(many).collect()}
    b = {r.doc_id: r.shard for r in ring.assign(many, shards=17).collect()}
    assert sum(a[d] != b[d] for d in a) < 0.5 * len(a)


def test_cascade_is_the_ring_walk():
    counts, owners, bounds = [5, 0, 7, 1], [1, 0, 1, 2], [4, 4, 5]
    ways = ring.cascade(counts, owners, bounds)
    assert [sum(n for _, n in w) for w in ways] == counts
    assert Counter({s: sum(n for w in ways for t, n in w if t == s) for s in range(3)}) == Counter({0: 4, 1: 4, 2: 5})


def test_decontamination(spark, empty):
    item = "Anna Smith sold 12 red apples and 7 green pears to Peter for 30 dollars before the market closed at noon on that day. Then Anna Smith went home with 12 coins."
    renamed = "Yesterday he said: " + item.replace("Anna Smith", "Julia Brown").replace("12", "45").replace("Peter", "Robert") + " And more."
    broken = item.replace("12", "45", 1)  # one 12 is 45, the other 12
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (None, item), (4, "")], "item_id long, text string")
    rows = [(1, prose(1, 50) + " " + item + " " + prose(2, 50)), (2, renamed), (3, broken), (4, None), (5, ""), (6, prose(3, 900)), (7, item.lower()), (7, item.lower()), (None, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in templates.matches(docs, bench).collect()}
    assert got == {(1, 1): "exact", (2, 1): "renamed", (7, 1): "exact"}
    assert sorted(str(r.doc_id) for r in templates.decontaminate(docs, bench).collect()) == ["3", "4", "5", "6", "None"]
    none = spark.createDataFrame([], "item_id long, text string")
    assert templates.matches(docs, none).count() == 0 and templates.matches(empty, bench).count() == 0


def test_names_that_open_sentences(spark):
    bench = spark.createDataFrame([(1, "Tom has 5 apples. Tom buys 3 more. How many apples does Tom have now?")], "item_id long, text string")
    texts = ["Ann has 7 apples. Ann buys 4 more. How many apples does Ann have now?", prose(1, 30) + ". Ann has 7 apples. Ann buys 4 more. How many apples does Ann have now? " + prose(2, 30),
             "Ann has 7 apples. Bob buys 4 more. How many apples does Eve have now?", prose(3, 60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted((r.doc_id, r.kind) for r in templates.matches(docs, bench).collect()) == [(0, "renamed"), (1, "renamed")]


def test_items_without_windows(spark, empty):
    items = ["What is 5 plus 7?", "12 + 30 = 42, 42 - 2 = 40, 40 / 8 = 5", "今天天气很好我们去公园散步吧", "วันนี้อากาศดีมาก", "Yes 3", "", "。。。"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [prose(1, 20) + " what is 5 plus 7 " + prose(2, 20), "What is 5 plus 8?", "so 12 + 30 = 42, 42 - 2 = 40, 40 / 8 = 5 it is", "他说今天天气很好我们去公园散步吧然后走了", "今天天气很好我们去公园吃饭吧",
             "เขาบอกว่าวันนี้อากาศดีมากจริงๆ", "yes 3 yes 3 yes 3", "yes 33", None, "What is 5 plus"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_windows, r.n_matched, r.kind) for r in templates.matches(docs, bench).collect())
    assert got == [(d, i, 1, 1, "exact") for d, i in [(0, 0), (2, 1), (3, 2), (5, 3), (6, 4)]]
    assert templates.matches(empty, bench).count() == 0


def test_preference_pairs(spark):
    ddl = "pair_id long, turn long, role string, text string, chosen string"
    same = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", "hello", "x")]
    a = spark.createDataFrame(same + [(1, 2, "user", "q?", "x"), (1, 3, "assistant", "good", "x"), (2, 0, "user", None, None), (None, 0, "user", "z", None), (3, 0, "user", "alone", None)], ddl)
    b = spark.createDataFrame(same + [(1, 2, "user", "q?", "x"), (1, 3, "assistant", "bad!!", "x"), (2, 0, "user", "", None)], ddl)
    got = {r.pair: r for r in preference.format_pairs(a, b, "pair_id").collect()}
    assert set(got) == {1, 2} and got[1].n_common == 3 and got[2].n_common == 1 and got[2].chosen == got[2].chosen_mask == ""
    r = got[1]
    assert r.prompt == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n<|im_start|>user\nq?<|im_end|>\n"
    for text, mask, want in ((r.chosen, r.chosen_mask, "good<|im_end|>"), (r.rejected, r.rejected_mask, "bad!!<|im_end|>")):
        start, end = map(int, mask.split("-"))
        assert text[start:end] == want
    own = preference.format_conversations(a.withColumnRenamed("pair_id", "conv_id")).collect()
    assert [(r.pair, r.rejected.count("hello")) for r in own] == [(1, 1)]


def test_main_text():
    page = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div class="menu"><a href=x>A</a></div><div id="content"><h1>T &amp; U</h1>
      <p>One two three four five six.<p>Second <a href=q>link</a> para &lt;x&gt; here<br>with words.<ul><li>item one<li>item two</ul><script>var p="</p>"</script></div>
      <div class="comments"><p>reader says many many words here really a lot of them so that they weigh more than anything</p></div><form>x</form><aside>side</aside><footer>f</footer>"""
    assert html_text.main_text(page) == "T & U\nOne two three four five six.\nSecond link para <x> here with words.\nitem one\nitem two"
    assert html_text.main_text("") == "" and html_text.main_text("plain &#x41;") == "plain A"
    assert html_text.main_text("<b>" * 5000 + "deep") == "deep"


def test_names_are_no_verdict():
    words = "Long enough sentences of an article that says many things about one matter and goes on for a while."
    for name in ("content has-sidebar", "no-comments", "social-science", "search-result-page", "layout-with-nav"):
        for tag in ("article", "section"):
            page = f"<html><body><div class='menu'><a href=x>A</a></div><div class='{name}'><{tag}><p>{words}</p><p>{words}</p></{tag}></div></body></html>"
            assert html_text.main_text(page) == f"{words}\n{words}"


def test_articles_beside_the_leading_one():
    words = [f"{w} sentences of an article that says many things about one matter and goes on for a while." for w in ("First", "Second", "Third")]
    page = "<html><body>" + "".join(f"<article><p>{w}</p><p>{w}</p></article>" for w in words) + "<article><a href=x>a</a> <a href=y>b</a></article></body></html>"
    assert html_text.main_text(page) == "\n".join(w for w in words for _ in "ab")


def test_pages_with_nulls(spark):
    pages = spark.createDataFrame([(1, None, None, 1), (2, "u", "<article><p>a b</p></article>", 1), (None, "u", "", 1)], "page_id long, url string, html string, text long")
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in html_text.extract(pages).collect()))
    assert got == [(0, "", 0), (1, "", 0), (2, "a b", 3)]


def test_pipeline_stages(spark):
    import corpus_pipeline
    out = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{out}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.written(stage(spark, docs, out), name)
        assert after.columns == docs.columns and 0 < after.count() <= n
        docs, n = after, after.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, out)
    assert packed.select("doc_id").distinct().count() == n


def test_pipeline_stages_on_awkward_rows(spark, docs, rows, empty):
    import corpus_pipeline
    out = "/root/testdata/sf0.001"
    good = [f"{prose(900 + i, 120)}\n{prose(950 + i, 60)}" for i in range(3)]
    extra = spark.createDataFrame([(900, good[0], "en", None, 1, None, None, None), (901, good[0], "en", None, 1, None, None, None),
                                   (None, good[1], None, "web", None, None, None, None), (902, good[2], None, None, None, 5, 6, "x")], docs.schema)
    every = docs.unionByName(extra)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.written(stage(spark, every, out), name)
        assert after.columns == every.columns
        assert stage(spark, empty, out).count() == 0
        every = after
    kept = every.select("doc_id", "text").collect()
    assert {900, 902, None} <= {r.doc_id for r in kept} and 901 not in {r.doc_id for r in kept}
    assert all(r.text for r in kept)
    stage = corpus_pipeline.STAGES[-1][1]
    assert stage(spark, empty, out).count() == 0
    assert stage(spark, every, out).where("piece = 0").count() == len(kept)


def test_encoder_remembers_in_generations():
    """Pieces that stay in use are worked out once, however many others come between, in bounded memory."""
    enc = Encoder(BYTE, True, most=200)
    found, asked = enc.known.find, Counter()

    def find(piece):
        asked[piece] += 1
        return found(piece)

    enc.known.find = find
    for i in range(400):
        text = f"the cat, {prose(i, 30)} sat."
        assert enc.encode([text])[0] == np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert len(enc.known) <= 100 and len(enc.known.old) <= 100
    assert asked["the"] == asked[" cat"] == asked[" sat."] == 1


def test_encoder_cuts_like_the_library():
    odd = ["a, b. c", "a ,b . c", " a,", "A.b c.", "x), y.. z", "é, ñ.\nÉa", "a\n b", "a \nb", "a \n \nb", " a  b", "a b.\n\n\nc d, e.\n", "a ., b", "_, a", "1, 2. x²,\ny", ", a", "a, b.\n \nc", "a\0b c\0", "\0 a", ",", " ,", " .", "a.", "İ, ß.", "don't, x", "²,", " ", "名前, 犬. x"]
    for path, keeps in ((BYTE, True), (PLAIN, False)):
        enc = Encoder(path, keeps)
        for x in odd * 2:
            assert enc.encode([x])[0] == np.asarray(enc.tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes(), x
