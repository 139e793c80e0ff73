"""Benchmark decontamination by templates: numbers, names and units become typed slots, and windows of the rest are joined.

Documents are read once. A bit table of fixed size, made from the benchmark, decides in the scan which windows are worth
a join; the join on the window's hash decides. Matches are then aligned: windows of one document and one item that follow each
other at distances a few words apart belong together, and each
value that fills the item's slots there must stand for one value of the document.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import ROW, arrow_batch, per_batch, row_key, staged, texts
from gridmart.llm.shingles import mixed

#: Words that name a unit after a number.
UNITS = frozenset(
    b"%|mm|cm|m|km|in|inch|inches|ft|foot|feet|yd|yard|yards|mi|mile|miles|g|kg|mg|t|lb|lbs|oz|ml|l|liter|liters|litre|litres|s|sec|second|seconds"
    b"|min|minute|minutes|h|hour|hours|day|days|week|weeks|month|months|year|years|c|f|k|degree|degrees|usd|eur|gbp|dollar|dollars|euro|euros|cent|cents"
    b"|percent|pound|pounds|ounce|ounces|gram|grams|meter|meters|metre|metres|mph|kmh|hz|khz|mhz|v|w|kw|j|n|pa".split(b"|")
)
_EDGE = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_EXACT = np.uint64(19)
_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (11, 13, 17))
_ODD = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)

#: Bits of the table, and of a part of it that Spark aggregates as one row.
BITS, PART = 1 << 24, 1 << 15
#: An item's window needs so many different words that are not slots to be matched by its template; others are matched verbatim.
MIN_LITERALS = 5
#: Words by which the distance of document and item may change from one window to the next: small edits of a copy.
DRIFT = 8
#: Words of an item in one piece that count whatever their share of the item is.
PASSAGE = 50
_GROUP_BYTES = 1 << 18

_WINDOWS = "h long, pos int, slots array<long>, exact boolean"
_FOUND = "cover double, n_windows long, n_slots long, kind string"


class _Words(dict):
    """What each written word is: a hash of its letters, and flags. Emptied when full."""

    NUMBER, TITLE, ENDS, UNIT = 1, 2, 4, 8

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        bare = word.strip(_EDGE)
        if not bare and word != b"%":
            self[word] = 0
            return 0
        if bare.isascii():
            folded, title = bare.lower(), bare[:1].isupper() and bare[1:].islower()
        else:
            text = bare.decode("utf-8", "replace")
            folded, title = text.lower().encode(), text[:1].isupper() and text[1:].islower()
        flags = self.TITLE if title else 0
        if bare[:1].isdigit() and not bare.strip(b"0123456789.,:/-"):
            flags |= self.NUMBER
        if not word.endswith(bare) or not bare:
            flags |= self.ENDS * word.rstrip(b"\"')]}%&#*$").endswith((b".", b"!", b"?", b":"))
        if (folded or word) in UNITS:
            flags |= self.UNIT
        self[word] = value = xxhash.xxh3_64_intdigest(folded or b"%") & ~15 | flags
        return value or 16


class Templates:
    """Words of texts as a template: slots, and what fills them."""

    def __init__(self) -> None:
        self.words = _Words()

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Template words of texts one after the other, what fills their slots (0 for a word that stays), and the text of each."""
        split = [text.split() for text in texts]
        sizes = [len(words) for words in split]
        coded = np.fromiter(map(self.words.__getitem__, itertools.chain.from_iterable(split)), np.uint64, sum(sizes))
        owner = np.repeat(np.arange(len(texts)), sizes)
        stays = coded != 0
        coded, owner = coded[stays], owner[stays]
        flags = coded & np.uint64(15)
        values = coded & ~np.uint64(15)
        begins = np.ones(len(owner), bool)
        begins[1:] = owner[1:] != owner[:-1]

        def behind(flag: int) -> np.ndarray:
            """Whether the word before, in the same text, has a flag."""
            has = np.zeros(len(flags), bool)
            has[1:] = (flags[:-1] & np.uint64(flag)) > 0
            return has & ~begins

        number = (flags & np.uint64(1)) > 0
        name = ((flags & np.uint64(2)) > 0) & ~begins & ~behind(4)
        unit = ((flags & np.uint64(8)) > 0) & behind(1)
        template = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, values)))
        return template, np.where(number | unit | name, values | np.uint64(16), np.uint64(0)), owner


def _hashes(template: np.ndarray, slots: np.ndarray, size: int, exact: bool) -> np.ndarray:
    """Hashes of all windows of ``size``: of the template, or of the words as written, the same whether they fill a slot or not."""
    words = np.where(slots != 0, slots, template) | np.uint64(16) if exact else template
    spread = mixed(words + _EXACT if exact else words)
    n = len(spread) - size + 1
    hashes = np.full(n, size, np.uint64)
    for k in range(size):
        hashes += spread[k : k + n] * _ODD[k]
    return mixed(hashes + _EXACT if exact else hashes).view(np.int64)


def _telling(template: np.ndarray, slots: np.ndarray, size: int) -> np.ndarray:
    """Whether each window of ``size`` has enough different words that are not slots."""
    words = np.where(slots == 0, template, 0)
    return np.array([len(np.unique(w := words[at : at + size])) - (0 in w) >= MIN_LITERALS for at in range(len(words) - size + 1)], bool)


def _groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in runs of about ``_GROUP_BYTES``, so that short ones share what each numpy call costs."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _GROUP_BYTES:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if texts:
        yield first, texts[first:]


def _window_table(df: DataFrame, ids: list, id_schema: str, kinds: list[tuple[int, bool]], bits: dict[bool, np.ndarray] | None = None) -> DataFrame:
    """Windows of each text: id columns, h, pos, what fills the slots, and whether h is of the words as written.

    ``kinds`` are the windows' lengths, and whether they are taken as written. With ``bits`` those that the table of their
    kind knows, else all: the telling ones by template, the others as written.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for batch in batches:
            index, hashes, places, filled, lengths, exact = [], [], [], [], [], []
            for first, group in _groups(texts(batch)):
                template, slots, owner = templates.tokens(group)
                starts = np.searchsorted(owner, np.arange(len(group)))
                for size, is_exact in kinds:
                    if len(template) < size:
                        continue
                    h = _hashes(template, slots, size, is_exact)
                    whole = owner[: len(h)] == owner[size - 1 :]
                    if bits is None:
                        chosen = whole & (_telling(template, slots, size) != is_exact)
                    else:
                        low = h & (BITS - 1)
                        chosen = whole & ((bits[is_exact][low >> 3] >> (low & 7).astype(np.uint8)) & 1).astype(bool)
                    pos = np.flatnonzero(chosen)
                    index.append(owner[pos] + first)
                    hashes.append(h[pos])
                    places.append(pos - starts[owner[pos]])
                    filled.append(slots[pos[:, None] + np.arange(size)].reshape(-1))
                    lengths.append(np.full(len(pos), size))
                    exact.append(np.full(len(pos), is_exact))
            joined = lambda parts, dtype: np.concatenate([np.empty(0, dtype), *parts]).astype(dtype)
            at = pa.array(joined(index, np.int64))
            columns = {c: batch.column(c).take(at) for c in batch.schema.names if c != "text"}
            ends = np.concatenate([[0], np.cumsum(joined(lengths, np.int64))]).astype(np.int32)
            slot_lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(joined(filled, np.uint64).view(np.int64)))
            yield arrow_batch(**columns, h=joined(hashes, np.int64), pos=joined(places, np.int32), slots=slot_lists, exact=pa.array(joined(exact, bool)))

    return df.select(*ids, "text").mapInArrow(scan, f"{id_schema}, {_WINDOWS}")


def _bit_table(windows: DataFrame) -> np.ndarray:
    """``BITS`` bits, those of the windows' hashes set: one row for each part reaches the driver, 2 MB in all."""
    low = F.col("h").bitwiseAND(BITS - 1)
    part = (low / PART).cast("int").alias("part")
    found = windows.select(part, F.pmod(low, F.lit(PART)).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    table = np.zeros((BITS // PART, PART // 8), np.uint8)
    for row in found:
        table[row.part] = np.frombuffer(bytes(row.bits), np.uint8)
    return table.reshape(-1)


def _item_sizes(benchmark: DataFrame) -> DataFrame:
    """item_id and the number of template words of each item."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for batch in batches:
            sizes = [len(templates.tokens([text])[0]) for text in texts(batch)]
            yield arrow_batch(item_id=batch.column("item_id"), item_words=pa.array(sizes, pa.int32()))

    return benchmark.select("item_id", "text").mapInArrow(scan, "item_id long, item_words int")


def _chains(at: list[dict], item_words: int) -> list[list[dict]]:
    """Windows of one document and item by alignment: in order on both sides, the distance changing by ``DRIFT`` at most."""
    done, open_chains = [], []
    for w in sorted(at, key=lambda w: (w["pos"], w["item_pos"])):
        shift = w["pos"] - w["item_pos"]
        done += [c for c in open_chains if c[-1]["pos"] < w["pos"] - item_words - DRIFT]
        open_chains = [c for c in open_chains if c[-1]["pos"] >= w["pos"] - item_words - DRIFT]
        apart = lambda c: abs(shift - c[-1]["pos"] + c[-1]["item_pos"])
        near = min((c for c in open_chains if c[-1]["item_pos"] < w["item_pos"] and apart(c) <= DRIFT), key=apart, default=None)
        if near is None:
            open_chains.append([w])
        else:
            near.append(w)
    return done + open_chains


def _pairs(w: dict) -> list[tuple[int, int]]:
    """What fills each slot of a window, in the item and in the document."""
    return [(i, d) for i, d in zip(w["item_slots"], w["slots"]) if i]


def _consistent(chain: list[dict]) -> list[dict]:
    """The windows of a chain without those whose slots contradict the rest.

    What fills a slot of the item stands for one value in the document: the one at most of its places, of equals the
    item's own. Two values of the item may stand for one. A window equal in words and slots contradicts nothing.
    """
    places = {(i, d, w["item_pos"] + k) for w in chain for k, (i, d) in enumerate(zip(w["item_slots"], w["slots"])) if i}
    counts = Counter((i, d) for i, d, _ in places)
    stands = {}
    for (i, d), n in counts.items():
        stands[i] = max(stands.get(i, (0, False, 0)), (n, i == d, d))
    return [w for w in chain if w["item_slots"] == w["slots"] or all(stands[i][2] == d for i, d in _pairs(w))]


def _covered(chain: list[dict]) -> set[int]:
    return {k for w in chain for k in range(w["item_pos"], w["item_pos"] + len(w["slots"]))}


def _longest(places: set[int]) -> int:
    """The most places in a row."""
    best = n = 0
    for k in sorted(places):
        n = n + 1 if k - 1 in places else 1
        best = max(best, n)
    return best


def _judged(min_cover: float) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """The best alignment of each document and item, if one counts."""

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        index, out = [], []
        for k, (words, at) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("item_words", "at")))):
            told = []
            for chain in map(_consistent, _chains(at, words)):
                covered = _covered(chain)
                cover = len(covered) / words
                if cover >= min_cover or _longest(covered) >= PASSAGE:
                    slots = {p for w in chain for p in _pairs(w)}
                    told.append((cover, len(chain), len(slots), "reparameterised" if any(i != d for i, d in slots) else "verbatim"))
            if told:
                index.append(k)
                out.append(max(told))
        columns = {c: batch.column(c).take(pa.array(index, pa.int64())) for c in (*ROW, "item_id")}
        kinds = {"cover": pa.float64(), "n_windows": pa.int64(), "n_slots": pa.int64(), "kind": pa.string()}
        return arrow_batch(**columns, **{c: pa.array([x[n] for x in out], kind) for n, (c, kind) in enumerate(kinds.items())})

    return judge


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = 8, min_cover: float = 0.5, rare: int = 10) -> DataFrame:
    """A row for each distinct document and benchmark item that it holds.

    Columns: doc_id, item_id, n_windows, cover (share of the item's words inside matching windows), n_slots (slots of the
    item that were compared), kind and the row key. kind is ``verbatim`` if all slots hold the same, and
    ``reparameterised`` if they differ by a replacement; windows whose slots contradict the rest of a match do not count.
    A pair counts from a cover of ``min_cover`` at one alignment, or with 50 words of the item in one piece; an alignment
    goes on over inserted and left out words, up to 8 at a place. Windows with fewer than 5 different words beside their
    slots are matched verbatim only. Items of fewer than ``window`` words are one window, however short. Such an item
    says little where it stands in many documents: its kind is ``short`` if it has fewer than 3 words, or if more than
    ``rare`` different documents hold it. Of several alignments of a pair that of the greatest cover is told, of equals
    the one with more windows, then slots.

    Texts may have any length and are read whole. Null or empty texts hold nothing, on either side; items without an id are ignored, and repeated items count once.
    Repeated rows give one result, rows that share an id or have none one each. Other columns are not read. Empty tables
    give an empty one.
    """
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id IS NOT NULL").dropDuplicates()
    sizes = _item_sizes(items)
    short = [r.item_words for r in sizes.where(F.col("item_words").between(1, window - 1)).select("item_words").distinct().collect()]
    kinds = [(size, exact) for size in sorted({*short, window}) for exact in (False, True)]
    item_windows = _window_table(items, ["item_id"], "item_id long", kinds)
    item_windows = item_windows.join(sizes, "item_id").where(F.size("slots") == F.least("item_words", F.lit(window)))
    # A window that an item repeats stands for its first place, so a match is one row for each place in the document.
    at = F.min(F.struct("pos", "slots", "exact")).alias("at")
    item_windows = staged(item_windows.groupBy("item_id", "item_words", "h").agg(at).select("item_id", "item_words", "h", "at.*"), "item_windows")
    # Only windows of a length and kind that the benchmark has can match, so only those are hashed.
    kinds = sorted((r.size, r.exact) for r in item_windows.select(F.size("slots").alias("size"), "exact").distinct().collect())
    bits = {exact: _bit_table(item_windows.where(F.col("exact") == exact)) for exact in {exact for _, exact in kinds}}

    hits = _window_table(docs, row_key(), "__row_id long, __row_hash long", kinds, bits)
    theirs = item_windows.select("h", "exact", "item_id", "item_words", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    same = F.when(F.col("exact"), F.col("item_slots")).otherwise(F.col("slots"))
    matched = hits.distinct().join(theirs, ["h", "exact"]).withColumn("slots", same)
    # Windows of one document, so a group is no larger than that.
    at = F.collect_list(F.struct("pos", "item_pos", "slots", "item_slots", "exact")).alias("at")
    grouped = matched.groupBy(*ROW, "item_id", "item_words").agg(at)
    found = staged(grouped.mapInArrow(per_batch(_judged(min_cover)), f"__row_id long, __row_hash long, item_id long, {_FOUND}"), "leaks")
    held = found.groupBy("item_id").agg(F.count("*").alias("holders")).join(sizes, "item_id")
    tiny = (F.col("item_words") < 3) | (F.col("holders") > rare)
    common = held.where((F.col("item_words") < window) & tiny).select("item_id", F.lit("short").alias("as"))
    told = found.join(common, "item_id", "left").withColumn("kind", F.coalesce("as", "kind"))
    ids = docs.select("doc_id", *row_key()).distinct()
    return ids.join(told, list(ROW)).select("doc_id", "item_id", "n_windows", "cover", "n_slots", "kind", *ROW)
