"""Benchmark decontamination by template canonicalisation.

Words become templates: numbers, units beside numbers and names (capitalised inside a
sentence) are replaced by typed placeholders, everything else by its lower-case form.
Windows of ``WINDOW`` template words of the documents are hash-joined with those of the
benchmark. Aligned windows must agree on their slots: within one alignment a benchmark
value may stand for one document value only, so "Tom has 5" matches "Ann has 7" only if
Tom is Ann and 5 is 7 throughout; two names may not become one, while two numbers may become equal.
Number words and units are known in English, German, Spanish and French. A second view without names finds passages whose case
was changed, a third one takes capitalised words that open a sentence as names too. A document holds an item if consistent windows cover at least ``COVER`` percent of
the item's windows.

Items that no view has a window of (few words, or almost only placeholders) and items in scripts
without blanks between words (Chinese, Japanese, Thai, Lao, Khmer, Burmese; a character is a token there) are joined
exactly as well: their whole sequence of lower-case tokens, punctuation left out, must stand in the document. The first
``WINDOW`` of these tokens lead, so a document is compared only where they stand.

Only windows that pass a bit map of the benchmark's window hashes (a fixed number of bits)
leave the scan of the documents, so the corpus is read once and never shuffled.

Cases: null texts have no words; very long texts are cut into windows like others, one text at a time; items under WINDOW words are matched as one window; items
without a word match nothing, an item of one word every document that holds the word; repeated
rows of a doc_id count as one document; an empty table on either side gives no matches;
null ids are left out of matches and such rows kept; all columns of the documents are kept, whatever their
names.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import WORD_CACHE, as_bytes, signed, windows, written

WINDOW = 8
LEAST = 4
#: literal words a window needs
LITERALS = 4
COVER = 60
MAP_BITS = 24

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+(?:[.,:/]\d+)*|[%$€£°]|[.!?…:;\n]")
_UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_UNSPACED_ANY = re.compile(f"[{_UNSPACED}]")
_OWN_TOKEN = re.compile(rf"[{_UNSPACED}]|[^\W\d_{_UNSPACED}]+(?:['’][^\W\d_{_UNSPACED}]+)*|\d+(?:[.,:/]\d+)*|[%$€£°]")
_END = "\x1f"
_STOPS = frozenset(".!?…:;\n")
#: FIXED VALUES: number words of English, German, Spanish and French; words that are articles too (un, una, ein, une) are left out
_NUMBERS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen
twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half third quarter
null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn
zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend millionen halb
cero dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho diecinueve
veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien ciento mil millón millones medio media tercio cuarto
zéro deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize
vingt trente quarante cinquante soixante cent cents mille millions demi demie tiers quart""".split())
#: FIXED VALUES: units of the same languages, slots only beside a number
_UNITS = frozenset("""% $ € £ ° mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds ounce ounces
ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years dollar dollars cent cents euro
euros percent degree degrees kmh mph watt watts volt volts joule joules meter meters metre metres centimeter centimeters kilometer kilometers""".split())
_UNITS_ABROAD = frozenset("""zoll fuß meile meilen gramm kilogramm pfund unze unzen tonne tonnen sekunde sekunden minuten stunde stunden tag tage tagen woche wochen
monat monate monaten jahr jahre jahren prozent grad zentimeter
pulgada pulgadas pie pies yarda yardas milla millas gramo gramos kilogramo kilogramos kilo kilos libra libras onza onzas tonelada toneladas litro litros galón galones
segundo segundos minuto minutos hora horas día días semana semanas mes meses año años dólar dólares centavo centavos céntimo céntimos grado grados
metro metros centímetro centímetros kilómetro kilómetros vatio vatios voltio voltios julio julios
pouce pouces pied pieds gramme grammes kilogramme kilogrammes livre livres once onces tonnes seconde secondes heure heures jour jours semaine semaines
mois an ans année années centime centimes degré degrés mètre mètres centimètre centimètres kilomètre kilomètres pourcent""".split())
STOP, NUMBER, UNIT, NAME = 1, 2, 3, 4
#: the number of the exact rows beside the three views
WHOLE = 3
_TOKENS: list = []


class _Tokens(dict):
    """token -> hash of its lower-case form and its kind, as 16 bytes."""

    def __missing__(self, token: str) -> bytes:
        low = token.lower()
        kind = STOP if token in _STOPS else NUMBER if token[0].isdigit() or low in _NUMBERS else UNIT if low in _UNITS or low in _UNITS_ABROAD else (
            NAME if token[0].isupper() and not token.isupper() else 0)
        found = xxhash.xxh3_64_digest(low.encode("utf-8", "replace")) + bytes([kind, 0, 0, 0, 0, 0, 0, 0])
        if len(token) <= 64:
            if len(self) >= WORD_CACHE:
                self.clear()
            self[token] = found
        return found


def canonical(text: str) -> tuple:
    """Hashes of the words' lower-case forms; per word the slot type (0 none) in the view with
    names, in the view without and in the view where names may open a sentence."""
    if not _TOKENS:
        _TOKENS.append(_Tokens())
    table = np.frombuffer(b"".join(map(_TOKENS[0].__getitem__, _TOKEN.findall(text))), "<u8").reshape(-1, 2)
    kind = table[:, 1]
    words = kind != STOP
    first = np.concatenate(([True], ~words[:-1]))[words]  # after a stop, or at the start
    own, kind = table[words, 0], kind[words]
    number = kind == NUMBER
    beside = np.zeros(len(own), bool)  # a unit is one only beside a number
    beside[1:] |= number[:-1]
    beside[:-1] |= number[1:]
    plain = np.where(number, NUMBER, np.where((kind == UNIT) & beside, UNIT, 0))
    return own, np.where((kind == NAME) & ~first, NAME, plain), plain, np.where(kind == NAME, NAME, plain)


def _views(text: str):
    """(view, hashes of the template words, the slot type of each (0 none), hashes of the own words)"""
    own, *every = canonical(text)
    for view, slots in enumerate(every):
        yield view, np.where(slots > 0, slots.astype(np.uint64), own) ^ np.uint64(view), slots, own


def _values(own: np.ndarray, slots: np.ndarray) -> list:
    """Hashes of a window's slot words; their two lowest bits hold the slot type (0 for a name)."""
    at = slots > 0
    return signed(own[at] & np.uint64(~3 & (1 << 64) - 1) | slots[at].astype(np.uint64) & np.uint64(3)).tolist()


def _own_tokens(text: str) -> list:
    """The text's lower-case tokens without stops; characters in scripts without blanks."""
    return [x.lower() for x in _OWN_TOKEN.findall(text)]


def _own_keys(text: str, own: np.ndarray) -> np.ndarray:
    """Hashes of ``_own_tokens``. ``own``: the hashes of the words, which they are but for scripts without blanks."""
    if text.isascii() or not _UNSPACED_ANY.search(text):
        return own
    return np.frombuffer(b"".join(map(_TOKENS[0].__getitem__, _OWN_TOKEN.findall(text))), "<u8").reshape(-1, 2)[:, 0]


def _joined(tokens: list) -> str:
    return "".join(x + _END for x in tokens)


_WIN = pa.schema([("id", pa.int64()), ("view", pa.int32()), ("at", pa.int32()), ("hash", pa.int64()), ("n", pa.int32()), ("k", pa.int32()), ("slots", pa.list_(pa.int64())), ("tokens", pa.string())])
_WIN_DDL = "id long, view int, at int, hash long, n int, k int, slots array<long>, tokens string"


def _rows(found: list):
    columns = list(zip(*found)) or [[]] * len(_WIN)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _WIN.types)], schema=_WIN)


def _literal(slot: np.ndarray, k: int) -> np.ndarray:
    """Whether each window of k words has enough words that are no slots."""
    sums = np.concatenate(([0], np.cumsum(~slot)))
    return sums[k:] - sums[:-k] >= min(LITERALS, k)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """id, view, at, hash, n (windows of the item in this view), k (their words), slots of every window. In the rows of
    view ``WHOLE`` hash is that of the first k tokens, n their number in all and tokens the whole sequence."""

    def cut(batches):
        for batch in batches:
            found = []
            for item, text in zip(batch.column("id").to_pylist(), as_bytes(batch.column("text"))):
                text, have = text.decode("utf-8", "replace"), len(found)
                for view, hashes, slot, own in _views(text):
                    if len(own) < LEAST:
                        continue
                    k = min(WINDOW, len(own))
                    good = np.flatnonzero(_literal(slot > 0, k))
                    keys = signed(windows(hashes, k))
                    found += [(item, view, int(i), int(keys[i]), len(good), k, _values(own[i:i + k], slot[i:i + k]), None) for i in good]
                if len(found) == have or _UNSPACED_ANY.search(text):
                    tokens, keys = _own_tokens(text), _own_keys(text, own)
                    k = min(WINDOW, len(keys))
                    if k:
                        found.append((item, WHOLE, 0, int(signed(windows(keys ^ np.uint64(WHOLE), k)[:1])[0]), len(tokens), k, None, _joined(tokens)))
            yield _rows(found)

    return benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string")).where("id IS NOT NULL").mapInArrow(cut, _WIN_DDL)


def _bit_map(items: DataFrame) -> np.ndarray:
    """MAP_BITS address bits: which windows can be in the benchmark. Its size is fixed."""
    low = F.pmod("hash", F.lit(1 << MAP_BITS))
    words = items.groupBy(F.shiftright(low, 5).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(hash, {1 << MAP_BITS}) & 31 AS int))")).alias("bits"))
    out = np.zeros(1 << (MAP_BITS - 5), np.uint32)
    table = words.toArrow()
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().astype(np.uint32)
    return out


def _document_windows(docs: DataFrame, bit_map: np.ndarray, lengths: list, whole: dict) -> DataFrame:
    """The documents' windows that pass the bit map. ``whole``: the most tokens of the exact items with k leading ones."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_map)

    def passing(bits, keys):
        low = keys & np.uint64((1 << MAP_BITS) - 1)
        return bits[(low >> np.uint64(5)).astype(np.int64)] >> (low & np.uint64(31)).astype(np.uint32) & np.uint32(1) == 1

    def leads(bits, doc, text, own):
        """Where an exact item's first tokens stand, with as many tokens as such an item has; equal ones once."""
        tokens, found = None, set()
        for k, most in whole.items():
            keys = windows(own ^ np.uint64(WHOLE), k)
            at = np.flatnonzero(passing(bits, keys))
            if k == most:  # nothing follows, so equal hashes are one
                at = at[np.unique(keys[at], return_index=True)[1]]
            if len(at) and tokens is None:
                tokens = _own_tokens(text)
            found.update((doc, WHOLE, 0, int(keys[i].view(np.int64)), 0, k, None, _joined(tokens[i:i + most])) for i in at.tolist())
        return found

    def cut(batches):
        bits = shared.value
        for batch in batches:
            found = []
            for doc, text in zip(batch.column("id").to_pylist(), as_bytes(batch.column("text"))):
                text = text.decode("utf-8", "replace")
                for view, hashes, slot, own in _views(text):
                    for k in lengths:
                        if len(own) < k:
                            continue
                        keys = windows(hashes, k)
                        at = np.flatnonzero(passing(bits, keys))
                        for i in at[_literal(slot > 0, k)[at]].tolist() if len(at) else ():
                            found.append((doc, view, i, int(keys[i].view(np.int64)), 0, k, _values(own[i:i + k], slot[i:i + k]), None))
                if whole:
                    found += leads(bits, doc, text, _own_keys(text, own))
                if len(found) > 20_000:
                    yield _rows(found)
                    found = []
            yield _rows(found)

    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string")).where("id IS NOT NULL").mapInArrow(cut, _WIN_DDL)


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows (of the item), n_matched, kind (exact, or renamed where
    slots differ) of every document that holds a benchmark item."""
    items = written(item_windows(benchmark), "items")
    shapes = items.groupBy((F.col("view") == WHOLE).alias("whole"), "k").agg(F.max("n").alias("most")).collect()  # LEAST .. WINDOW, and 1 .. WINDOW
    whole = {r.k: r.most for r in shapes if r.whole}
    found = _document_windows(docs, _bit_map(items), [r.k for r in shapes if not r.whole], whole)
    if whole:
        found = written(found, "hits")  # few, and read twice
    hits = found.where(F.col("view") != WHOLE).select(
        F.col("id").alias("doc_id"), "view", F.col("at").alias("doc_at"), "hash", F.col("slots").alias("doc_slots"))
    joined = hits.join(items.where(F.col("view") != WHOLE).select(F.col("id").alias("item_id"), "view", "at", "hash", F.col("n").alias("n_windows"), "slots"), ["hash", "view"])
    pairs = F.arrays_zip(F.col("slots").alias("item"), F.col("doc_slots").alias("doc"))
    # one alignment of one item in one document: at most the item's windows
    aligned = joined.select("doc_id", "item_id", "view", "n_windows", "at", (F.col("doc_at") - F.col("at")).alias("shift"), pairs.alias("pairs")).groupBy(
        "doc_id", "item_id", "view", "n_windows", "shift").agg(F.collect_set("at").alias("ats"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    one = F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"])))
    # and two names of the item are two names of the document (numbers may coincide)
    names = F.filter("pairs", lambda p: p["item"].bitwiseAND(F.lit(3)) == 0)
    apart = F.size(F.array_distinct(F.transform(names, lambda p: p["doc"]))) == F.size(names)
    consistent = aligned.where((one == F.size("pairs")) & apart).withColumn("same", F.forall("pairs", lambda p: p["item"] == p["doc"]))
    views = consistent.groupBy("doc_id", "item_id", "view", "n_windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("ats")))).cast("long").alias("n_matched"), F.min("same").alias("same"))
    enough = views.where(F.col("n_matched") * 100 >= F.col("n_windows") * COVER)
    if whole:
        leading = found.where(F.col("view") == WHOLE).select(F.col("id").alias("doc_id"), "hash", F.col("tokens").alias("doc_tokens"))
        exact = leading.join(items.where(F.col("view") == WHOLE).select(F.col("id").alias("item_id"), "hash", "tokens"), "hash").where(F.expr("startswith(doc_tokens, tokens)"))
        one = F.lit(1).cast("long")
        enough = enough.select("doc_id", "item_id", F.col("n_windows").cast("long").alias("n_windows"), "n_matched", "same").unionByName(
            exact.select("doc_id", "item_id", one.alias("n_windows"), one.alias("n_matched"), F.lit(True).alias("same")))
    best = enough.groupBy("doc_id", "item_id").agg(F.max("n_windows").cast("long").alias("n_windows"), F.max("n_matched").alias("n_matched"), F.max("same").alias("same"))
    return best.select("doc_id", "item_id", "n_windows", "n_matched", F.when(F.col("same"), "exact").otherwise("renamed").alias("kind"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns."""
    found = matches(docs, benchmark).select(F.col("doc_id").alias("__hit")).distinct()
    return docs.join(found, F.col("doc_id").cast("long") == F.col("__hit"), "left_anti")
