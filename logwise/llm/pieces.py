"""SentencePiece encoding and decoding by vectorised merge rounds, and token
counts by a two-tier pre-token lookup.

Encoding works on a flat numpy array of symbols, all words of a batch side by
side. Each round finds the smallest pair rank per word (a segmented minimum),
merges its leftmost occurrence in every word at once and compacts the array;
words without a pair leave. One merge per word and round is what the model's
priority queue does (a merge may create a better pair than the next equal
one), so the ids are exactly the library's.

Texts are cut into pre-tokens before each run of word marks. That is exact
only if no piece of the model has a mark after another character; a model
that has such pieces is encoded as one word per text.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwise.llm.common import forget_words, ship_package

MARK = "▁"
#: Words of more symbols are merged by a heap; their rounds would be quadratic.
LONG_WORD = 400
#: Entries of a worker's pre-token cache; it is emptied when full.
CACHE = 400_000
#: Characters of text that a task encodes at a time.
ENCODE_CHARS = 1_000_000
NO_RANK = np.iinfo(np.int64).max

ENCODED = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _single_byte(error: UnicodeDecodeError):
    return "�", error.start + 1


codecs.register_error("logwise-single-byte", _single_byte)


class PieceModel:
    """Vocabulary of a BPE model file with byte fallback, as numpy tables.

    The library reads the file (pieces, scores, kinds); merging and decoding
    are done here.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self.normal = {
            p: i
            for i, p in enumerate(pieces)
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        }
        self.unk = sp.unk_id()
        self.splits = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.normal)
        byte_ids = np.full(256, self.unk, dtype=np.int64)
        for i in range(n):
            if sp.is_byte(i):
                byte_ids[int(pieces[i][1:-1], 16)] = i
        self.byte_ids = byte_ids
        # symbols: ids of pieces, then characters that only occur inside pieces
        symbols = dict(self.normal)
        for p in self.normal:
            for c in p:
                symbols.setdefault(c, n + len(symbols))
        self.size = n
        self.char = {c: s for c, s in symbols.items() if len(c) == 1}
        self.symbols = symbols
        order = sorted({sp.get_score(i) for i in self.normal.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(order)}
        self.base = 1 << 20  # above it: characters outside the vocabulary, by code point
        pairs = {}
        for p, i in self.normal.items():
            r = rank[sp.get_score(i)]
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (r, i)
        self.pairs = pairs
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.keys = keys
        self.ranks = np.array([pairs[k][0] for k in keys.tolist()], dtype=np.int64)
        self.merged = np.array([pairs[k][1] for k in keys.tolist()], dtype=np.int64)
        # code point -> symbol, for the basic plane; others go through the dict
        plane = np.arange(0x10000, dtype=np.int64) + self.base
        for c, s in self.char.items():
            if ord(c) < 0x10000:
                plane[ord(c)] = s
        self.plane = plane
        self.astral = {ord(c): s for c, s in self.char.items() if ord(c) >= 0x10000}
        # decoding: bytes of every id
        text = [b""] * n
        for p, i in self.normal.items():
            text[i] = p.replace(MARK, " ").encode()
        for b in range(256):
            if byte_ids[b] != self.unk:
                text[int(byte_ids[b])] = bytes([b])
        if self.unk >= 0:
            text[self.unk] = sp.decode([self.unk]).encode()
        self.text = text
        self.text_len = np.array([len(t) for t in text], dtype=np.int64)
        self.text_start = np.concatenate([[0], np.cumsum(self.text_len)[:-1]])
        self.text_flat = np.frombuffer(b"".join(text), dtype=np.uint8)
        self.id_text = [str(i) for i in range(n)]
        self.strips = sp.decode(sp.encode("a")) == "a" and pieces[sp.encode("a")[0]].startswith(MARK)

    # -- encoding ---------------------------------------------------------

    def pretokens(self, text: str) -> list[str]:
        """Pre-tokens of a text, with the dummy prefix and marks for spaces."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return _PRETOKEN.findall(marked) if self.splits else [marked]

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_RANK), self.merged[at]

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each pre-token (int32 arrays), in order; vectorised rounds."""
        out: list[np.ndarray | None] = [None] * len(words)
        short = []
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = self._encode_long(w)
            elif w:
                short.append(i)
            else:
                out[i] = np.empty(0, dtype=np.int32)
        if short:
            lengths = np.array([len(words[i]) for i in short], dtype=np.int64)
            flat = np.frombuffer("".join(words[i] for i in short).encode("utf-32-le", "surrogatepass"), dtype="<u4")
            symbols = self._symbols(flat.astype(np.int64))
            owner = np.repeat(np.arange(len(short)), lengths)
            ids, owner = self._bytes(*self._merge(symbols, owner, len(short)))
            ends = np.searchsorted(owner, np.arange(len(short) + 1))
            ids = ids.astype(np.int32)
            for k, i in enumerate(short):
                out[i] = ids[ends[k] : ends[k + 1]]
        return out

    def _symbols(self, points: np.ndarray) -> np.ndarray:
        low = points < 0x10000
        symbols = np.where(low, self.plane[np.where(low, points, 0)], points + self.base)
        if not low.all() and self.astral:
            for i in np.flatnonzero(~low):
                symbols[i] = self.astral.get(int(points[i]), symbols[i])
        return symbols

    def _merge(self, symbols: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Rounds over the words that still have a pair; returns all symbols.

        ``rank`` and ``merged`` describe the pair that starts at a symbol. A
        merge changes two pairs of its word, so only those are looked up again.
        """
        done_s, done_o = [], []
        rank = np.full(len(symbols), NO_RANK)
        merged = np.zeros(len(symbols), dtype=np.int64)
        at = np.flatnonzero(owner[:-1] == owner[1:])
        rank[at], merged[at] = self._lookup(symbols[at], symbols[at + 1])
        while len(symbols):
            edge = np.append(True, owner[1:] != owner[:-1])
            first = np.flatnonzero(edge)
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(symbols)))
            idle = best == NO_RANK
            if idle.any():
                out = np.repeat(idle, sizes)
                done_s.append(symbols[out])
                done_o.append(owner[out])
                live = ~out
                symbols, owner, rank, merged = symbols[live], owner[live], rank[live], merged[live]
                best, sizes = best[~idle], sizes[~idle]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            # the leftmost hit of each word
            hit = hit[np.append(True, owner[hit][1:] != owner[hit][:-1])]
            symbols[hit] = merged[hit]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hit + 1] = False
            symbols, owner, rank, merged = symbols[keep], owner[keep], rank[keep], merged[keep]
            hit -= np.arange(len(hit))  # each earlier word lost one symbol
            before = hit[hit > 0] - 1
            for left in (hit, before[owner[before] == owner[before + 1]]):
                right = np.minimum(left + 1, len(symbols) - 1)
                rank[left], merged[left] = self._lookup(symbols[left], symbols[right])
                rank[left[(right == left) | (owner[left] != owner[right])]] = NO_RANK
        if not done_s:
            return symbols, owner
        s, o = np.concatenate(done_s), np.concatenate(done_o)
        order = np.argsort(o, kind="stable")
        return s[order], o[order]

    def _bytes(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no pieces become the ids of their UTF-8 bytes."""
        odd = np.flatnonzero(symbols >= self.size)
        if not len(odd):
            return symbols, owner
        inside = {s: c for c, s in self.char.items() if s >= self.size}
        parts, counts = [], np.ones(len(symbols), dtype=np.int64)
        for i in odd:
            s = int(symbols[i])
            c = inside[s] if s in inside else chr(s - self.base)
            ids = self.byte_ids[np.frombuffer(c.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
            parts.append(ids)
            counts[i] = len(ids)
        out, own = np.repeat(symbols, counts), np.repeat(owner, counts)
        at = np.cumsum(counts) - counts
        for i, ids in zip(odd, parts, strict=True):
            out[at[i] : at[i] + len(ids)] = ids
        return out, own

    def _encode_long(self, word: str) -> np.ndarray:
        """The same merges for one long word, by a heap over a linked list."""
        points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        sym = self._symbols(points).tolist()
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs, heap = self.pairs, []

        def push(i: int) -> None:
            j = nxt[i]
            if j < n and (found := pairs.get(sym[i] << 32 | sym[j])):
                heap.append((found[0], i, sym[i], sym[j], found[1]))

        for i in range(n - 1):
            push(i)
        heapq.heapify(heap)
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = nxt[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = m, -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for k in (prv[i], i):
                if k >= 0 and nxt[k] < n and (found := pairs.get(sym[k] << 32 | sym[nxt[k]])):
                    heapq.heappush(heap, (found[0], k, sym[k], sym[nxt[k]], found[1]))
        left = np.array([s for s in sym if s >= 0], dtype=np.int64)
        return self._bytes(left, np.zeros(len(left), dtype=np.int64))[0].astype(np.int32)

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: pieces and byte pieces joined, one leading space of the
        first piece dropped, invalid bytes replaced one by one."""
        ids = np.asarray(ids, dtype=np.int64)
        if not len(ids):
            return ""
        size = self.text_len[ids]
        ends = np.cumsum(size)
        if not ends[-1]:
            return ""
        at = np.arange(ends[-1]) + np.repeat(self.text_start[ids] - (ends - size), size)
        raw = self.text_flat[at].tobytes()
        skip = int(self.strips and raw[:1] == b" " and self._first_has_mark(ids, size))
        # tokens without text (control ids) end a run of byte pieces
        cuts = [skip, *np.unique(ends[(size == 0) & (ends > skip) & (ends < ends[-1])]).tolist(), int(ends[-1])]
        return "".join([raw[i:j].decode("utf-8", "logwise-single-byte") for i, j in zip(cuts, cuts[1:])])

    def _first_has_mark(self, ids: np.ndarray, size: np.ndarray) -> bool:
        first = int(ids[np.flatnonzero(size)[0]])
        return first != self.unk and first not in self.byte_ids


_PRETOKEN = re.compile(f"{MARK}+[^{MARK}]*")


@functools.lru_cache(maxsize=2)
def load_model(path: str) -> PieceModel:
    """The model of this Python worker."""
    return PieceModel(path)


class Encoder:
    """Whole-text encoder with a bounded cache of pre-tokens, whose ids are
    kept as raw bytes: a third of the memory of as many small arrays."""

    def __init__(self, model: PieceModel, limit: int = CACHE):
        self.model, self.limit = model, limit
        self.ids: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        words = [self.model.pretokens(t) for t in texts]
        known = self.ids
        if len(known) > self.limit:
            known.clear()
        fresh = list({w for ws in words for w in ws if w not in known})
        for k in range(0, len(fresh), 50_000):
            part = fresh[k : k + 50_000]
            for w, ids in zip(part, self.model.encode_words(part), strict=True):
                known[w] = ids.tobytes()
        return [np.frombuffer(b"".join(map(known.__getitem__, ws)), dtype=np.int32) for ws in words]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker; its cache outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(load_model(path))
    return _ENCODERS[path]


def slices(texts: list[str], chars: int = 4_000_000) -> Iterator[slice]:
    """Runs of whole texts of about ``chars`` characters."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= chars:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def encode_documents(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, with_text: bool = True
) -> DataFrame:
    """Token ids of every whole text and their decoded text, as digests.

    Result: id, n_tokens, ids_sha256, decoded_sha256; with ``with_ids`` also
    ``ids`` (array<int>) and, unless ``with_text`` is off, ``decoded`` (string).
    Null text counts as empty: no tokens, digests of the empty string. Repeated rows and null ids are
    kept row by row; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = dict(docs.dtypes)[id_col]
    extra = (", ids array<int>" + ", decoded string" * with_text) * with_ids

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_words()
        enc = encoder(model_path)
        model = enc.model
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["t"]]
            for part in slices(texts, ENCODE_CHARS):
                rows = {"id": pdf["id"].iloc[part].to_numpy(), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
                kept, decoded = [], []
                names = model.id_text
                for ids in enc.encode(texts[part]):
                    text = model.decode(ids)
                    rows["n_tokens"].append(len(ids))
                    rows["ids_sha256"].append(
                        hashlib.sha256(",".join([names[i] for i in ids.tolist()]).encode()).hexdigest()
                    )
                    rows["decoded_sha256"].append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
                    if with_ids:
                        kept.append(ids)
                        decoded += [text] * with_text
                if with_ids:
                    rows |= {"ids": kept} | ({"decoded": decoded} if with_text else {})
                yield pd.DataFrame(rows)

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInPandas(
        run, f"id {kind}, {ENCODED}{extra}"
    )
    return out.withColumnRenamed("id", id_col)


# -- token counts ----------------------------------------------------------


class Counter:
    """Lengths of pre-tokens: broadcast table first, then this worker's cache,
    filled by the library in batches of misses."""

    def __init__(self, path: str, limit: int = CACHE):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.model, self.limit = load_model(path), limit
        self.cache: dict[str, int] = {}

    def fill(self, words: list[str]) -> None:
        # the library adds the dummy prefix itself; a lone mark is one piece
        plain = [w[1:].replace(MARK, " ") for w in words]
        for w, ids in zip(words, self.sp.encode(plain, num_threads=1), strict=True):
            self.cache[w] = len(ids) if len(w) > 1 else 1

    def count(self, texts: list[str], frequent: dict[str, int]) -> list[int]:
        cache, out = self.cache, []
        if len(cache) > self.limit:
            cache.clear()
        for text in texts:
            words = self.model.pretokens(text)
            sizes = list(map(frequent.get, words))
            if None in sizes:
                missed = [w for w, n in zip(words, sizes, strict=True) if n is None]
                fresh = [w for w in dict.fromkeys(missed) if w not in cache]
                if fresh:
                    self.fill(fresh)
                out.append(sum(n for n in sizes if n is not None) + sum(map(cache.__getitem__, missed)))
            else:
                out.append(sum(sizes))
        return out


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of this Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def frequent_pretokens(
    docs: DataFrame, model_path: str, text_col: str = "text", fit_rows: int = 2_000, table_size: int = 20_000
) -> dict[str, int]:
    """Lengths of the ``table_size`` most frequent pre-tokens of about
    ``fit_rows`` rows drawn by a hash of the text.

    The table only saves work: a pre-token that it lacks is encoded by the
    worker that meets it, so the sample has no influence on any count.
    """
    from collections import Counter as Tally

    total = docs.count()
    if not total:
        return {}
    share = min(1.0, fit_rows / total)
    bound = int(share * 1_000_000)
    drawn = docs.where(F.pmod(F.xxhash64(F.col(text_col)), F.lit(1_000_000)) < F.lit(max(1, bound)))
    drawn = drawn.select(F.col(text_col).alias("t")).limit(2 * fit_rows)
    model, tally = load_model(model_path), Tally()
    for row in drawn.toLocalIterator():
        if row["t"]:
            tally.update(model.pretokens(row["t"]))
    top = [w for w, _ in sorted(tally.items(), key=lambda x: (-x[1], x[0]))[:table_size] if len(w) <= 64]
    own = Counter(model_path)
    own.fill(top)
    return own.cache


def count_tokens(
    docs: DataFrame,
    model_path: str,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = 2_000,
    table_size: int = 20_000,
) -> DataFrame:
    """Token count of every whole text: id, n_bytes, n_tokens, over_limit.

    Map-side only: no pre-token is shuffled. The broadcast table holds at most
    ``table_size`` pre-tokens of at most 64 characters (a few MB). Null text
    counts as empty (0 bytes, 0 tokens). Repeated rows and null ids are kept;
    other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = dict(docs.dtypes)[id_col]
    table = spark.sparkContext.broadcast(frequent_pretokens(docs, model_path, text_col, fit_rows, table_size))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, frequent = counter(model_path), table.value
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["t"]]
            yield pd.DataFrame({"id": pdf["id"].to_numpy(), "b": pdf["b"].to_numpy(), "n": own.count(texts, frequent)})

    source = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("t"),
        F.coalesce(F.octet_length(F.col(text_col)).cast("long"), F.lit(0).cast("long")).alias("b"),
    )
    counted = source.mapInPandas(run, f"id {kind}, b long, n long")
    return counted.select(
        F.col("id").alias(id_col),
        F.col("b").alias("n_bytes"),
        F.col("n").alias("n_tokens"),
        (F.col("n") > F.lit(limit)).alias("over_limit"),
    )
