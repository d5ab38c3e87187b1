"""Removal of repeated 100-byte strings by a distributed difference-cover suffix comparison.

Every window of 100 bytes is assigned to one position of it, its anchor: the leftmost 32-byte string
with the smallest hash. Equal windows have equal anchors at equal offsets, so windows can only repeat
among occurrences of one anchor string, and a shuffle by that string brings them together.
An occurrence ships as one row: the hash of its anchor, the hash of the bytes under all its windows,
and its place. Of occurrences with the same bytes only the earliest can hold a new window; the others are
covered at once, in a block of documents before the shuffle (so a string that fills a third of the
corpus ships once a block) and again after it. Where one anchor string has several different surroundings, the earliest of each are
compared suffix by suffix: columns 1 and 2 modulo 3 (a difference cover) are the sample; sampled triples
are sorted into names, names are combined by threes and sorted again (9, 27, 81 bytes), the
remaining column is merged by its byte and the name to its right, and equal neighbours in the sorted
order are repeats. Only the first 100 bytes of a suffix matter, so the recursion stops there.

Defined cases: NULL or empty text has no bytes; texts below 100 bytes lose nothing; a NULL id counts as
smaller than any other; rows with equal id and text are one document and get the same result, rows
with equal id and other text are ordered by text hash; texts of any length are read in blocks; an empty
table gives an empty result; further columns of the input do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_code, text_or_empty, written

WIDTH = 100
ANCHOR = 32
REACH = WIDTH - ANCHOR + 1  # anchors that a window can choose from
BLOCK = 1 << 20
#: Surroundings compared in one vector step; groups above this are compared by window hash instead.
BATCH = 6000
MIN_LONG = -(1 << 63)
_OFFSET = REACH - 1

_rng = np.random.default_rng(7)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    p = _powers.get(base, np.ones(1, dtype=np.uint64))
    while len(p) < n:
        p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
    _powers[base] = p
    return p[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def occurrences(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: (anchor hash, hash of all their bytes, first window, windows, offset of the anchor)."""
    parts = []
    for at in range(0, max(len(data) - WIDTH + 1, 0), BLOCK):
        block = np.frombuffer(data, dtype=np.uint8, count=min(BLOCK + WIDTH - 1, len(data) - at), offset=at)
        n = len(block)
        up, down = _power(_BASE, n), _power(_INVERSE, n)
        h = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[block] * up, out=h[1:])
        grams = _mix((h[ANCHOR:] - h[:-ANCHOR]) * down[:n - ANCHOR + 1])
        # Leftmost minimum over REACH neighbours: windows of doubling size, then two that overlap.
        low, place, size = grams, np.arange(len(grams)), 1
        while 2 * size <= REACH:
            left = low[:-size] <= low[size:]
            low, place = np.where(left, low[:-size], low[size:]), np.where(left, place[:-size], place[size:])
            size *= 2
        shift, windows = REACH - size, n - WIDTH + 1
        if shift:
            left = low[:windows] <= low[shift:shift + windows]
            place = np.where(left, place[:windows], place[shift:shift + windows])
        first = np.flatnonzero(np.append(True, place[1:windows] != place[:windows - 1]))
        count = np.diff(np.append(first, windows))
        anchor = place[first]
        span = (h[first + count - 1 + WIDTH] - h[first]) * down[first]
        offset = anchor - first
        around = _mix(span + _mix((offset * 128 + count).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        parts.append((grams[anchor], around, first + at, count, offset))
    if not parts:
        e = np.empty(0, dtype=np.int64)
        return e.astype(np.uint64), e.astype(np.uint64), e, e, e
    return tuple(np.concatenate(x) for x in zip(*parts))


# A place is one number, ordered by text hash, then position: tag (16 bits), first window (33), windows - 1 (7), offset (7).
def pack(tag, first, count, offset):
    return (tag << 47) | (first << 14) | (count - 1) << 7 | offset


def unpack(place: np.ndarray):
    return place >> 47, (place >> 14) & ((1 << 33) - 1), ((place >> 7) & 127) + 1, place & 127


def combine(gram: np.ndarray, around: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of occurrences with the same bytes, only the earliest can hold a new window. Gives (rows to compare, rows
    that are covered); a row that is a second copy of the earliest place is in neither."""
    key = around ^ _mix(gram)
    order = np.argsort(key, kind="stable")
    run = np.append(True, key[order][1:] != key[order][:-1])
    alone = run & np.append(run[1:], True)
    some = order[~alone]
    some = some[np.lexsort((place[some], doc[some], key[some]))]
    head = np.append(True, key[some][1:] != key[some][:-1]) if len(some) else np.empty(0, dtype=bool)
    first = some[np.flatnonzero(head)[np.cumsum(head) - 1]] if len(some) else some
    covered = some[~head & ((doc[some] != doc[first]) | (place[some] != place[first]))]
    return np.concatenate([order[alone], some[head]]), covered


def _emit_occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), 1000):
            part, out = b.iloc[at:at + 1000], []
            for doc, tag, text in zip(part["doc"], part["tag"], part["text"]):
                gram, around, first, count, offset = occurrences(text.encode("utf-8", "surrogatepass"))
                if len(gram):
                    out.append((gram.view(np.int64), around.view(np.int64), np.full(len(gram), doc, dtype=np.int64), pack(int(tag), first, count, offset)))
            if out:
                gram, around, doc, place = (np.concatenate(x) for x in zip(*out))
                compare, covered = combine(gram.view(np.uint64), around.view(np.uint64), doc, place)
                # What is covered already goes along under a key of its own, so hot strings do not gather.
                spread = _mix(place[covered].view(np.uint64) + _mix(doc[covered].view(np.uint64))).view(np.int64)
                yield pd.DataFrame({"gram": np.concatenate([gram[compare], spread]), "around": np.concatenate([around[compare], around[covered]]),
                                    "doc": np.concatenate([doc[compare], doc[covered]]), "place": np.concatenate([place[compare], place[covered]]),
                                    "covered": np.arange(len(compare) + len(covered)) >= len(compare)})


def _classify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (gram, around, doc, place), as a stream. Gives the later rows of each class (kind
    'covered') and the first rows of the classes of every gram that has several ('open'). What is
    carried from batch to batch is the last class and, while a gram has one class, its first row."""
    last = None  # (gram, around, doc, place) of the first row of the last class
    held = None  # the same, if it is the only class of its gram so far
    for b in batches:
        done = b["covered"].to_numpy(dtype=bool)
        if done.any():
            yield pd.DataFrame({"kind": "covered", "gram": b["gram"][done], "doc": b["doc"][done], "place": b["place"][done]})
        g, a, d, p = (b[c].to_numpy()[~done] for c in ("gram", "around", "doc", "place"))
        if not len(g):
            continue
        if last is not None:
            g, a, d, p = (np.append(np.int64(x), y) for x, y in zip(last, (g, a, d, p)))
        new_gram = np.append(True, g[1:] != g[:-1])
        new_class = new_gram | np.append(True, a[1:] != a[:-1])
        heads = np.flatnonzero(new_class)
        head_of = heads[np.cumsum(new_class) - 1]
        covered = ~new_class & ((d != d[head_of]) | (p != p[head_of]))
        # A class head is open if the class before or after it has the same gram.
        gram_of = g[heads]
        joined = gram_of[1:] == gram_of[:-1]
        is_open = np.append(joined, False) | np.append(False, joined)
        carried = last is not None and held is None  # the first head was given out before
        if carried:
            is_open[0] = False
        at = heads[is_open]
        last = tuple(int(x[heads[-1]]) for x in (g, a, d, p))
        same_gram_before = len(heads) > 1 and joined[-1] or len(heads) == 1 and carried
        held = None if same_gram_before else last
        for kind, rows in (("covered", np.flatnonzero(covered)), ("open", at)):
            if len(rows):
                yield pd.DataFrame({"kind": kind, "gram": g[rows], "doc": d[rows], "place": p[rows]})


def _zip_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        yield pd.DataFrame({"doc": b["doc"], "tag": b["tag"], "z": [z.compress(t.encode("utf-8", "surrogatepass")) for t in b["text"]]})


def _surroundings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes under the windows of each open place."""
    z = zstandard.ZstdDecompressor()
    for b in batches:
        for doc, data, grams, places in zip(b["doc"], b["z"], b["grams"], b["places"]):
            text = z.decompress(data)
            places = np.asarray(places, dtype=np.int64)
            _, first, count, _ = unpack(places)
            yield pd.DataFrame({"gram": np.asarray(grams, dtype=np.int64), "doc": np.full(len(places), doc, dtype=np.int64), "place": places,
                                "around": [text[f:f + c + WIDTH - 1] for f, c in zip(first.tolist(), count.tolist())]})


def _names(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1].reshape(key.shape).astype(np.int64)


def repeated_windows(around: list[bytes], count: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Rows in order of appearance; (row, column) is True where the window that starts ``_OFFSET - column`` before
    the anchor equals that window of an earlier row."""
    n, width = len(around), _OFFSET + WIDTH
    lengths = np.fromiter(map(len, around), dtype=np.int64, count=n)
    flat = np.frombuffer(b"".join(around), dtype=np.uint8)
    row = np.repeat(np.arange(n), lengths)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(_OFFSET - offset, lengths)
    symbols, code = np.unique(flat, return_inverse=True)
    text = np.zeros((n, width), dtype=np.int64)  # 0 stands outside the known bytes
    text[row, col] = code + 1
    bits = int(len(symbols)).bit_length()
    cover = np.arange(width - 2)
    cover = cover[cover % 3 != 0]
    index = np.full(width, -1)
    index[cover] = np.arange(len(cover))
    # Sampled triples: in a small alphabet a triple of symbols is its own name; else the triples are sorted.
    name = text[:, cover] << 2 * bits | text[:, cover + 1] << bits | text[:, cover + 2]
    size = 3
    if 9 * bits > 62:
        name = _names(name)
    while size < 81:  # names of three neighbours, `size` apart, are sorted into names of three times the length
        cover = cover[(cover + 2 * size < width) & (index[np.minimum(cover + 2 * size, width - 1)] >= 0)]
        a, b, c = (name[:, index[cover + k * size]] for k in range(3))
        shift = int(name.max(initial=0)).bit_length()
        if 3 * shift > 62:
            raise ValueError("too many names for one step")
        name = _names(a << 2 * shift | b << shift | c)
        index = np.full(width, -1)
        index[cover] = np.arange(len(cover))
        size *= 3
    columns = np.arange(_OFFSET + 1)
    sampled = columns % 3 != 0
    shift = max(int(name.max(initial=0)).bit_length(), 1)
    key = np.empty((n, _OFFSET + 1), dtype=np.int64)
    # 100 bytes: names at the column and 18 on, and the last symbol; or the first symbol and names 1 and 19 on.
    w = columns[sampled]
    key[:, w] = name[:, index[w]] << shift + bits | name[:, index[w + 18]] << bits | text[:, w + WIDTH - 1]
    w = columns[~sampled]
    key[:, w] = name[:, index[w + 1]] << shift + bits | name[:, index[w + 19]] << bits | text[:, w]
    known = (columns >= (_OFFSET - offset)[:, None]) & (columns < (_OFFSET - offset + count)[:, None])
    where = np.flatnonzero(known.ravel())
    key = _names(key.ravel()[where]) * (_OFFSET + 1) + where % (_OFFSET + 1)
    order = np.argsort(key, kind="stable")
    equal = np.append(False, key[order][1:] == key[order][:-1])  # neighbours; stable, so the earliest row leads
    out = np.zeros(n * (_OFFSET + 1), dtype=bool)
    out[where[order[equal]]] = True
    return out.reshape(n, _OFFSET + 1)


def _runs(doc: np.ndarray, place: np.ndarray, mask: np.ndarray) -> pd.DataFrame:
    """Maximal runs of True columns as places of covered windows."""
    tag, first, _, offset = unpack(place)
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, start = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    begin = first[row] + start - (_OFFSET - offset[row])
    return pd.DataFrame({"doc": doc[row], "tag": tag[row], "first": begin, "count": end - start})


def _resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows clustered by gram: whole groups are compared, several at a time."""
    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc", "place"]).drop_duplicates(["gram", "doc", "place"])
        place = frame["place"].to_numpy()
        _, _, count, offset = unpack(place)
        return _runs(frame["doc"].to_numpy(), place, repeated_windows(frame["around"].tolist(), count, offset))

    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        held.append(b)
        if sum(map(len, held)) >= BATCH:
            frame = pd.concat(held, ignore_index=True)
            g = frame["gram"].to_numpy()
            cut = len(g) - int((g[::-1] != g[-1]).argmax()) if (g != g[-1]).any() else 0
            at = 0
            starts = np.append(np.flatnonzero(np.append(True, g[1:] != g[:-1])), len(g))
            while at < cut:  # as many whole groups as fit a step
                fits = starts[(starts > at) & (starts <= cut) & (starts - at <= BATCH)]
                end = int(fits[-1]) if len(fits) else int(starts[starts > at][0])
                yield compare(frame.iloc[at:end])
                at = end
            held = [frame.iloc[cut:]]
    rest = pd.concat(held, ignore_index=True) if held else None
    if rest is not None and len(rest):
        yield compare(rest)


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    z = zstandard.ZstdDecompressor()
    for b in batches:
        rows = []
        for doc_id, data, first, count in zip(b["doc_id"], b["z"], b["first"], b["count"]):
            text = z.decompress(data)
            kept, at, removed, spans = hashlib.sha256(), 0, 0, 0
            if first is not None and len(first):
                first = np.asarray(first, dtype=np.int64)
                end = first + np.asarray(count, dtype=np.int64) - 1 + WIDTH
                order = np.argsort(first)
                first, end = first[order], np.maximum.accumulate(end[order])
                lead = np.append(True, first[1:] > end[:-1])  # touching spans are one run
                begins, ends = first[lead], np.append(end[np.flatnonzero(lead)[1:] - 1], end[-1])
                spans = len(begins)
                for s, e in zip(begins.tolist(), ends.tolist()):
                    kept.update(text[at:s])
                    removed += e - s
                    at = e
            kept.update(text[at:])
            rows.append((doc_id, len(text), removed, spans, kept.hexdigest()))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def covered_windows(d: DataFrame) -> DataFrame:
    """(doc, tag, first, count): runs of windows that start earlier elsewhere, of keyed documents (doc, tag, text)."""
    n = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = d.mapInPandas(_emit_occurrences, "gram bigint, around bigint, doc bigint, place bigint, covered boolean")
    classed = written(found.repartition(n, "gram").sortWithinPartitions("gram", "around", "doc", "place")
                      .mapInPandas(_classify, "kind string, gram bigint, doc bigint, place bigint"), "sub-classes")

    tag = F.shiftright("place", 47)
    opened = classed.where("kind = 'open'")
    sizes = written(opened.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BATCH), "sub-large")
    by_doc = (opened.join(sizes, "gram", "left").withColumn("large", F.col("n").isNotNull())
              .groupBy("doc", tag.alias("tag")).agg(F.collect_list(F.struct("gram", "place")).alias("o")))
    texts = d.mapInPandas(_zip_texts, "doc bigint, tag bigint, z binary")
    around = (texts.join(by_doc, ["doc", "tag"]).select("doc", "z", F.col("o.gram").alias("grams"), F.col("o.place").alias("places"))
              .mapInPandas(_surroundings, "gram bigint, doc bigint, place bigint, around binary"))
    if sizes.isEmpty():
        resolved = around.repartition(n, "gram").sortWithinPartitions("gram").mapInPandas(_resolve, "doc bigint, tag bigint, first bigint, count bigint")
    else:
        around = written(around, "sub-around")
        few = around.join(sizes, "gram", "left_anti")
        resolved = (few.repartition(n, "gram").sortWithinPartitions("gram").mapInPandas(_resolve, "doc bigint, tag bigint, first bigint, count bigint")
                    .unionByName(_resolve_large(around.join(sizes, "gram", "left_semi"))))
    covered = classed.where("kind = 'covered'").select(
        "doc", tag.alias("tag"), F.shiftright("place", 14).bitwiseAND(F.lit((1 << 33) - 1)).alias("first"),
        (F.shiftright("place", 7).bitwiseAND(F.lit(127)) + 1).alias("count"))
    return covered.unionByName(resolved)


def _resolve_large(around: DataFrame) -> DataFrame:
    """Groups too large for one step: a row per window, the earliest of equal windows found by partial
    aggregation, so a group is spread over all tasks."""
    count = F.shiftright("place", 7).bitwiseAND(F.lit(127)) + 1
    rows = around.select(
        "doc", "place", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)).alias("k"), "around").select(
        "doc", "place", "k", F.sha2(F.substring("around", (F.col("k") + 1).cast("int"), F.lit(WIDTH)), 256).alias("window"))
    rows = written(rows.dropDuplicates(["doc", "place", "k"]), "sub-windows")
    at = F.shiftright("place", 14).bitwiseAND(F.lit((1 << 33) - 1)) + F.col("k")
    spot = F.struct(F.col("doc").alias("doc"), F.shiftright("place", 47).alias("tag"), at.alias("first"))
    first = rows.groupBy("window").agg(F.min(spot).alias("spot"))
    return (rows.join(first, "window").where(spot != F.col("spot"))
            .select("doc", F.shiftright("place", 47).alias("tag"), at.alias("first"), F.lit(1).cast("bigint").alias("count")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per document."""
    ship_code(docs.sparkSession)
    text: Column = text_or_empty(text_col)
    d = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(MIN_LONG)).alias("doc"),
                    F.xxhash64(text).bitwiseAND(F.lit(0xFFFF)).alias("tag"), text.alias("text"))
    windows = covered_windows(d).groupBy("doc", "tag").agg(F.collect_list(F.struct("first", "count")).alias("w"))
    zipped = d.mapInPandas(_zip_texts, "doc bigint, tag bigint, z binary")
    whole = zipped.join(windows, ["doc", "tag"], "left").select(
        F.when(F.col("doc") != MIN_LONG, F.col("doc")).alias("doc_id"), "z", F.col("w.first").alias("first"), F.col("w.count").alias("count"))
    return whole.mapInPandas(_cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
