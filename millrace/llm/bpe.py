"""BPE encoding and decoding with a transducer lexicon.

The words of the whole corpus are counted; the frequent ones are compiled, with their ids, into a
minimal acyclic transducer that the workers memory-map. A text is normalised and cut into words;
the distinct words of a block are looked up in the transducer, and words that it does not hold are
merged exactly, lowest rank first, leftmost first. The lexicon only saves time: ids do not depend on it.

Defined cases: NULL or empty text gives no ids; texts of any length are processed in pieces cut at
blanks, so memory is bounded by a piece; the tokenizer's special strings in a text give their ids;
repeated rows each give a row; an empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_code, text_or_empty, written
from .lexicon import Lexicon, compile_lexicon

#: At most this many frequent words are compiled (a size limit of the lexicon, not of the input).
LEXICON_WORDS = 65_536
#: Texts are encoded in pieces of about this many characters.
PIECE_CHARS = 2_000_000
#: Words above this many bytes are merged with a heap instead of by scanning.
LONG_WORD = 64

# Fixed values of the tokenizer format: white space, and the split pattern over it.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Tokenizer:
    """Vocabulary, merge ranks and the exact merge."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        vocab, end = d["model"]["vocab"], d["model"]["end_of_word_suffix"] or ""
        chars = byte_chars()
        self.first = [vocab.get(c) for c in chars]
        self.last = [vocab.get(c + end) for c in chars]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(d["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        pairs = sorted(self.merges.items())
        self._keys = np.array([a << 32 | b for (a, b), _ in pairs], dtype=np.int64)
        self._ranks = np.array([r for _, (r, _) in pairs], dtype=np.int64)
        self._made = np.array([n for _, (_, n) in pairs], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words_any = regex.compile(rf"{CONTRACTIONS}|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
        # The same pattern over Latin text, where the standard library is faster.
        latin = [chr(c) for c in range(0x250)]
        letters = "".join(map(re.escape, (c for c in latin if unicodedata.category(c)[0] == "L")))
        numbers = "".join(map(re.escape, (c for c in latin if unicodedata.category(c)[0] == "N")))
        self.words_latin = re.compile(f"{CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{WHITE}{letters}{numbers}]+")
        self.beyond_latin = re.compile("[^\\x00-\\u024f]")

    def split(self, text: str) -> list[str]:
        """Normalised words of a text without special strings."""
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ").lower()  # per character: no final-sigma rule
        return (self.words_any if self.beyond_latin.search(text) else self.words_latin).findall(text)

    def merge(self, word: bytes) -> list[int]:
        """Exact BPE of one word: always the pair of lowest rank, leftmost first."""
        ids = [i for i in [*(self.first[b] for b in word[:-1]), self.last[word[-1]]] if i is not None]
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        merges = self.merges
        while len(ids) > 1:
            best, at = None, -1
            for k, pair in enumerate(zip(ids, ids[1:])):
                m = merges.get(pair)
                if m is not None and (best is None or m < best):
                    best, at = m, k
            if best is None:
                break
            ids[at:at + 2] = [best[1]]
        return ids

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of many words at once: one round makes the best merge of every word that has one."""
        out: list[list[int]] = [[]] * len(words)
        short = []
        for k, w in enumerate(words):
            if len(w) > LONG_WORD or len(w) < 2:
                out[k] = self.merge(w)
            else:
                short.append(k)
        if not short or not len(self._keys):
            return [x or self.merge(w) for x, w in zip(out, words)]
        first, last = (np.array([-1 if i is None else i for i in t], dtype=np.int64) for t in (self.first, self.last))
        data = np.frombuffer(b"".join(words[k] for k in short), dtype=np.uint8)
        sizes = np.fromiter((len(words[k]) for k in short), dtype=np.int64, count=len(short))
        ids, owner = first[data], np.repeat(np.arange(len(short)), sizes)
        ends = np.cumsum(sizes) - 1
        ids[ends] = last[data[ends]]
        owner, ids = owner[ids >= 0], ids[ids >= 0]
        no_rank = np.iinfo(np.int64).max
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            key = ids[:-1] << 32 | ids[1:]
            at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            ok = (self._keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(ok, self._ranks[at], no_rank), no_rank)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(ids)))
            live = np.repeat(best < no_rank, counts)
            done.append((owner[~live], ids[~live]))
            # The leftmost pair of the best rank in each word that still has one.
            hit = np.flatnonzero((rank == np.repeat(best, counts)) & live)
            hit = hit[np.append(True, owner[hit[1:]] != owner[hit[:-1]])] if len(hit) else hit
            ids[hit] = self._made[at[hit]]
            live[hit + 1] = False
            ids, owner = ids[live], owner[live]
        owner = np.concatenate([o for o, _ in done])
        ids = np.concatenate([i for _, i in done])[np.argsort(owner, kind="stable")].tolist()
        cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(short)))]).tolist()
        for j, k in enumerate(short):
            out[k] = ids[cuts[j]:cuts[j + 1]]
        return out

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        right = [*range(1, n), -1]
        left = [-1, *range(n - 1)]
        merges = self.merges
        heap = [(m[0], k, m[1], ids[k], ids[k + 1]) for k in range(n - 1) if (m := merges.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        ids = [*ids]
        while heap:
            _, k, new, a, b = heapq.heappop(heap)
            r = right[k]
            if ids[k] != a or r < 0 or ids[r] != b:
                continue
            ids[k], ids[r] = new, None
            right[k] = right[r]
            if right[k] >= 0:
                left[right[k]] = k
            for x in (left[k], k):
                if x >= 0 and right[x] >= 0 and (m := merges.get((ids[x], ids[right[x]]))):
                    heapq.heappush(heap, (m[0], x, m[1], ids[x], ids[right[x]]))
        return [i for i in ids if i is not None]


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text before blanks into pieces of at least ``size`` characters (a blank belongs to no word)."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


class Encoder:
    """A tokenizer with its lexicon; yields (ids, decoded) strings of blocks of texts."""

    def __init__(self, tokenizer: Tokenizer, lexicon: Lexicon):
        self.tokenizer, self.lexicon = tokenizer, lexicon
        self._known: dict[int, tuple[int, str, str]] = {}  # by word number, so at most one entry a lexicon word

    def ids_of(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of the distinct words: by the transducer, else by the exact merge."""
        known, unseen = self._look_up(words)
        return {w: self.lexicon.output(n) for w, n in known} | unseen

    def _look_up(self, words: list[str]) -> tuple[list[tuple[str, int]], dict[str, list[int]]]:
        distinct = list(set(words))
        encoded = [w.encode() for w in distinct]
        numbers = self.lexicon.numbers(encoded).tolist()
        missing = [k for k, n in enumerate(numbers) if n < 0]
        merged = self.tokenizer.merge_many([encoded[k] for k in missing])
        return ([(w, n) for w, n in zip(distinct, numbers) if n >= 0],
                {distinct[k]: ids for k, ids in zip(missing, merged)})

    def parts(self, text: str) -> Iterator[tuple[str | None, int | None]]:
        """(piece, None) and (None, special id) in text order."""
        t = self.tokenizer
        spans = t.special_split.split(text) if t.special_split else [text]
        for s in spans:
            if s in t.special:
                yield None, t.special[s]
            elif s:
                for p in pieces(s):
                    yield p, None

    def encode(self, text: str) -> list[int]:
        return next(self.encode_many([text])).tolist()

    def blocks(self, texts: list[str]) -> Iterator[list[list[tuple[list[str] | None, int | None]]]]:
        """Consecutive texts of about ``PIECE_CHARS`` in all, each as its parts: (words, None) or (None, special id)."""
        block, held = [], 0
        for text in texts:
            if block and held + len(text) > PIECE_CHARS:
                yield block
                block, held = [], 0
            block.append([(None, sp) if sp is not None else (self.tokenizer.split(p), None) for p, sp in self.parts(text)])
            held += len(text)
        if block:
            yield block

    def encode_many(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        for block in self.blocks(texts):
            table = self.ids_of([w for parts in block for ws, _ in parts if ws for w in ws])
            place = {w: k for k, w in enumerate(table)}
            lengths = np.fromiter(map(len, table.values()), dtype=np.int64, count=len(table))
            starts = np.cumsum(lengths) - lengths
            flat = np.fromiter(chain.from_iterable(table.values()), dtype=np.int32, count=int(lengths.sum()))
            for parts in block:
                out = [np.empty(0, dtype=np.int32)]
                for ws, special in parts:
                    if special is not None:
                        out.append(np.array([special], dtype=np.int32))
                    else:
                        at = np.fromiter(map(place.__getitem__, ws), dtype=np.int64, count=len(ws))
                        n = lengths[at]
                        out.append(flat[np.repeat(starts[at] - np.cumsum(n) + n, n) + np.arange(n.sum())])
                yield np.concatenate(out)

    def decode(self, ids) -> str:
        """The vocabulary's tokens, joined by blanks (the format has no decoder)."""
        return " ".join(map(self.tokenizer.tokens.__getitem__, ids))

    def digests(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, sha256 of the ids, sha256 of the decoded text) per text. Texts above a block go
        through the hashes piece by piece."""
        short: list[str] = []
        for text in texts:
            if len(text) > PIECE_CHARS:
                yield from self._digest_short(short)
                short = []
                yield self._digest_long(text)
            else:
                short.append(text)
        yield from self._digest_short(short)

    def _digest_short(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        for block in self.blocks(texts):
            yield from self._digest_block(block)

    def _strings(self, words: list[str]) -> dict[str, tuple[int, str, str]]:
        """Per distinct word that has ids: their number, and both strings."""
        known, unseen = self._look_up(words)
        table = {w: self._string(i) for w, i in unseen.items() if i}
        cache = self._known
        for w, n in known:
            if (x := cache.get(n)) is None:
                x = cache[n] = self._string(self.lexicon.output(n))
            table[w] = x
        return table

    def _string(self, ids: list[int]) -> tuple[int, str, str]:
        return len(ids), " ".join(map(str, ids)), self.decode(ids)

    @staticmethod
    def _joined(words: list[str], table: dict[str, tuple[int, str, str]]) -> tuple[int, str, str]:
        found = [x for x in map(table.get, words) if x]  # a vocabulary may lack some bytes: words without ids leave nothing
        n, ids, decoded = zip(*found) if found else ((), (), ())
        return sum(n), " ".join(ids), " ".join(decoded)

    def _special(self, i: int) -> tuple[int, str, str]:
        return 1, str(i), self.tokenizer.tokens[i]

    def _digest_block(self, block) -> Iterator[tuple[int, str, str]]:
        table = self._strings([w for parts in block for ws, _ in parts if ws for w in ws])
        for parts in block:
            found = [self._special(sp) if sp is not None else self._joined(ws, table) for ws, sp in parts]
            found = [x for x in found if x[0]]
            yield (sum(x[0] for x in found), hashlib.sha256(" ".join(x[1] for x in found).encode()).hexdigest(),
                   hashlib.sha256(" ".join(x[2] for x in found).encode()).hexdigest())

    def _digest_long(self, text: str) -> tuple[int, str, str]:
        total, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for piece, special in self.parts(text):
            words = [] if special is not None else self.tokenizer.split(piece)
            n, i, d = self._special(special) if special is not None else self._joined(words, self._strings(words))
            if n:
                lead = " " if total else ""
                ids.update((lead + i).encode())
                decoded.update((lead + d).encode())
                total += n
        return total, ids.hexdigest(), decoded.hexdigest()


#: ASCII letters in lower case, bytes of other characters as they are; everything else separates words.
_WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
#: Different words that a task counts before it passes them on.
COUNTED_WORDS = 1 << 20


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word, n: partial counts of the words of all texts. A task passes its counts on whenever it holds
    ``COUNTED_WORDS`` words, and at its end."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = [w for w in held if len(w) <= LONG_WORD]
            batch = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in words], pa.string()), pa.array([held[w] for w in words], pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for b in batches:
            for text in b.column(0):
                raw = text.as_py().encode().translate(_WORD_BYTES)
                for at, end in spans_at_blanks(raw):
                    held.update(raw[at:end].split())
                if len(held) > COUNTED_WORDS:
                    yield out()
        if held:
            yield out()

    return docs.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "word string, n bigint")


def spans_at_blanks(raw: bytes, size: int = PIECE_CHARS) -> Iterator[tuple[int, int]]:
    """Pieces of at least ``size`` bytes, but for the last, that end before a blank."""
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + size) if len(raw) - at > size else -1
        end = len(raw) if end < 0 else end
        yield at, end
        at = end


def frequent_words(docs: DataFrame, text_col: str = "text", limit: int = LEXICON_WORDS) -> list[str]:
    """The frequent words of the whole corpus: all words whose count reaches the least count that
    at most ``limit`` words reach. Words are counted by partial sums; the driver gets the histogram of
    counts, bounded by its distinct values, and at most ``limit`` words."""
    counts = word_counts(docs, text_col).groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts.where("n > 1"), "word-counts")
    least, total = None, 0
    # Counts are binned by powers of 2^(1/8), so the histogram stays short at any corpus size.
    bins = counts.groupBy(F.floor(8 * F.log2("n")).alias("bin")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least"))
    for row in bins.orderBy(F.desc("bin")).collect():
        total += row["words"]
        if total > limit:
            break
        least = row["least"]
    return [] if least is None else [r["word"] for r in counts.where(F.col("n") >= least).select("word").collect()]


_loaded: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per Python worker, known by what it is made of."""
    spec, blob = shared.value
    key = hashlib.sha256(spec.encode() + blob).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Encoder(Tokenizer(spec), Lexicon.mapped(blob))
    return _loaded[key]


def shared_lexicon(docs: DataFrame, tokenizer_path: str, text_col: str = "text", limit: int = LEXICON_WORDS):
    """Broadcast (tokenizer file, serialised transducer): both bounded, by the vocabulary and by ``limit``."""
    ship_code(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    t = Tokenizer(spec)
    entries = {}
    for w in frequent_words(docs, text_col, limit):
        for n in t.split(w):
            entries[n.encode()] = t.merge(n.encode())
    return docs.sparkSession.sparkContext.broadcast((spec, compile_lexicon(entries)))


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the ``carry`` columns, ids array<int>."""
    shared = shared_lexicon(docs, tokenizer_path, text_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(shared)
        for b in batches:
            for at in range(0, len(b), 500):  # bounds the ids held at once
                part = b.iloc[at:at + 500]
                yield part[["doc_id", *carry]].assign(ids=list(encoder.encode_many(part["text"].tolist())))

    d = docs.select(F.col(id_col).alias("doc_id"), *carry, text_or_empty(text_col).alias("text"))
    types = ", ".join(f"`{c}` {d.schema[c].dataType.simpleString()}" for c in ("doc_id", *carry))
    return d.mapInPandas(run, f"{types}, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, text of (doc_id, ids)."""
    ship_code(encoded.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        tokens = encoded.sparkSession.sparkContext.broadcast(Tokenizer(f.read()).tokens)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = tokens.value
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": [" ".join(table[int(i)] for i in ids) for ids in b["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(
        run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def digest(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           limit: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: ``encode`` and ``decode`` without returning the ids."""
    shared = shared_lexicon(docs, tokenizer_path, text_col, limit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(shared)
        for b in batches:
            rows = list(encoder.digests(b["text"].tolist()))
            n, ids, decoded = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": np.array(n, dtype=np.int64),
                                "ids_sha256": list(ids), "decoded_sha256": list(decoded)})

    d = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return d.mapInPandas(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, "
                              "ids_sha256 string, decoded_sha256 string")
