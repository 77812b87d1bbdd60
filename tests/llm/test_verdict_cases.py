"""Templates in four languages and names one to one; several rows of one doc_id in the near-duplicate join."""
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from faultline.llm import jaccard, templates  # noqa: E402


@pytest.fixture(scope="module")
def spark():
    from faultline.session import get_session
    return get_session("local[4]", 4, app="faultline-tests")


def kinds(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted((r.doc_id, r.item_id, r.kind) for r in templates.matches(docs, bench).collect())


def test_number_words_and_units_of_four_languages(spark):
    pairs = [("El tren recorre 120 kilómetros en dos horas y Ana compra cinco libros para su hermana que vive en Madrid desde hace tres años",
              "El tren recorre 90 millas en tres horas y Eva compra siete libros para su hermana que vive en Sevilla desde hace ocho meses"),
             ("Le train parcourt deux cents kilomètres en trois heures et ensuite il revient à la gare en sept heures avec Marie",
              "Le train parcourt quatre cents mètres en huit minutes et ensuite il revient à la gare en neuf minutes avec Julie"),
             ("wie weit fährt er in zwei stunden wenn er für jede strecke fünf minuten braucht und dann noch drei tage wartet",
              "wie weit fährt er in sieben tagen wenn er für jede strecke acht sekunden braucht und dann noch vier wochen wartet"),
             ("A train covers two miles in five minutes and then it waits for three hours until it goes back again",
              "A train covers nine yards in six seconds and then it waits for eight days until it goes back again")]
    got = kinds(spark, [a for a, _ in pairs], [b for _, b in pairs])
    assert got == [(i, i, "renamed") for i in range(4)]


def test_two_names_stay_two(spark):
    item = "Yesterday Tom bought 5 books for the brother of his friend in Rome and gave 3 of them to Maria"
    one = "Yesterday Ann bought 5 books for the brother of his friend in Ann and gave 3 of them to Ann"
    two = "Yesterday Ann bought 4 books for the brother of his friend in Oslo and gave 4 of them to Eva"
    assert kinds(spark, [item], [one, two]) == [(1, 0, "renamed")]


def test_windows_equal_brute_force(spark):
    """Documents with planted, renamed and inconsistent items against the definition, without hashes."""
    rng = np.random.default_rng(4)
    names, words = ["Tom", "Ann", "Eva", "Bob"], [f"w{c}" for c in "abcdefghij"]

    def sentence(n):
        return [str(rng.choice(names)) if x < 0.15 else str(rng.integers(2, 99)) if x < 0.3 else str(rng.choice(words)) for x in rng.random(n)]

    items = [["so", *sentence(16)] for _ in range(12)]
    texts = []
    for item in items:
        swap = dict(zip(names, rng.permutation(names)))
        renamed = [swap.get(w, w) for w in item]
        broken = ["Ann" if w in names else w for w in item]
        texts += [["so", *sentence(5), *x, *sentence(5)] for x in (item, renamed, broken)]

    def kind(w):
        return "N" if w.isdigit() else "A" if w in names else ""

    def found(doc, item):
        best = None
        for view in (0, 1):
            typed = [k if k != "A" or view == 0 else "" for k in map(kind, item)]
            own = [k if k != "A" or view == 0 else "" for k in map(kind, doc)]
            good = [i for i in range(len(item) - 7) if sum(not k for k in typed[i:i + 8]) >= 4]
            ats, same = set(), True
            for shift in range(-len(item), len(doc)):
                hit = [i for i in good if 0 <= i + shift <= len(doc) - 8 and all(
                    typed[i + j] == own[i + j + shift] and (typed[i + j] or item[i + j].lower() == doc[i + j + shift].lower()) for j in range(8))]
                pairs = {(item[i + j], doc[i + j + shift]) for i in hit for j in range(8) if typed[i + j]}
                people = {p for p in pairs if p[0] in names}
                if hit and len({a for a, _ in pairs}) == len(pairs) and len({b for _, b in people}) == len(people):
                    ats |= set(hit)
                    same &= all(a == b for a, b in pairs)
            if good and ats and 100 * len(ats) >= templates.COVER * len(good):
                best = "exact" if same or best == "exact" else "renamed"
        return best

    want = sorted((d, i, found(doc, item)) for d, doc in enumerate(texts) for i, item in enumerate(items) if found(doc, item))
    assert kinds(spark, [" ".join(x) for x in items], [" ".join(x) for x in texts]) == want
    assert {k for _, _, k in want} == {"exact", "renamed"} and len(want) < len(texts)


def test_rows_of_one_doc_id(spark):
    rng = np.random.default_rng(8)
    a, b, c = (" ".join(f"v{x}" for x in rng.integers(0, 10_000, 120)) for _ in range(3))
    near = b.split()
    near[60] = "other"
    rows = [(1, a), (1, b), (2, " ".join(near)), (3, c), (4, a), (4, a), (5, None), (5, "z"), (6, "z"), (7, None), (7, ""), (None, a), (8, c), (8, "z")]
    got = sorted(tuple(r) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    sizes = {a: 116, b: 116, c: 116, " ".join(near): 116, "z": 1, None: 0, "": 0}
    top = {1: 1, 2: 1, 4: 1, 3: 3, 5: 3, 6: 3, 8: 3, 7: 7}
    assert got == sorted((d, sizes[t], top[d]) for d, t in rows if d is not None)
