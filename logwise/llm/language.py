"""Language identification by a linear-chain conditional random field.

Each word gets a label. Its score per label is a sum of weights of hashed
features: affixes, character n-grams inside word marks, the word itself (the
lexicon) and its shape. Learned transitions tie neighbouring words, so a
switch of language inside a text costs evidence. Forward-backward gives the
probability of each label at each word; a text's language is the label of the
largest mean probability, which is its score.

The field is fitted on a bounded, documented number of documents per
language, cut into runs that are joined into code-switched sequences.
Prediction reads whole texts in one map pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logwise.llm.common import mix64, ship_package

#: Label of texts without a letter.
UNDETERMINED = "und"
#: Hashed features; the weight table is (BUCKETS, labels) in single precision.
BUCKETS = 1 << 16
#: Words whose scores a worker remembers; emptied when full.
CACHE = 300_000


def held_out(id_col: Column, folds: int = 4, fold: int = 2) -> Column:
    """True where crc32 of the id as text leaves ``fold``; null ids: false."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))


def has_letter(word: str) -> bool:
    return any(c.isalpha() for c in word)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature buckets, owning word), words in order of ``owner``.

    Edge characters that are no letters are dropped before marking, so "le,"
    and "le" agree; the shape feature still sees the written form.
    """
    cores = []
    for w in words:
        core = w
        while core and not core[0].isalpha():
            core = core[1:]
        while core and not core[-1].isalpha():
            core = core[:-1]
        cores.append("\x02" + core.lower() + "\x03")
    size = np.array([len(c) for c in cores], dtype=np.int64)
    start = np.cumsum(size) - size
    flat = np.frombuffer("".join(cores).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(flat)) - start[owner]
    left = size[owner] - place
    hashes, owners = [], []
    base = np.uint64(0x100000001B3)
    rolling = np.zeros(len(flat), dtype=np.uint64)
    for n in range(1, 5):
        rolling = rolling[: len(flat) - n + 1] * base + flat[n - 1 :] if n > 1 else flat.copy()
        ok = left[: len(rolling)] >= n
        if n == 1:
            continue
        if n == 4:  # longest affixes only at the edges
            ok &= (place[: len(rolling)] == 0) | (left[: len(rolling)] == n)
        at = np.flatnonzero(ok)
        hashes.append(rolling[at] ^ np.uint64(n << 56))
        owners.append(owner[at])
    whole = [hash_text(c) for c in cores]
    hashes.append(np.array(whole, dtype=np.uint64))
    owners.append(np.arange(len(words)))
    shapes = [(w.isupper() << 2) | (w[:1].isupper() << 1) | any(c.isdigit() for c in w) for w in words]
    hashes.append(np.array(shapes, dtype=np.uint64) + np.uint64(77 << 48))
    owners.append(np.arange(len(words)))
    bucket = (mix64(np.concatenate(hashes)) & np.uint64(BUCKETS - 1)).astype(np.int64)
    own = np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return bucket[order], own[order]


def hash_text(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def emissions(weights: np.ndarray, words: list[str]) -> np.ndarray:
    """Label scores of each word, (words, labels)."""
    if not words:
        return np.zeros((0, weights.shape[1]), dtype=np.float32)
    bucket, owner = word_features(words)
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    return np.add.reduceat(weights[bucket], first, axis=0)


def marginals(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many sequences at once.

    ``scores`` holds the words of all sequences one after another. Sequences
    are walked side by side, longest first, so a step touches only those that
    still run. Returns the label probabilities of every word and the expected
    transition counts.
    """
    labels = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    steps = int(lengths.max(initial=0))
    alive = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(steps), side="right")
    offset = np.concatenate([[0], np.cumsum(alive)])
    begin = np.cumsum(lengths) - lengths
    seq = np.repeat(np.arange(len(lengths)), lengths)
    place = offset[np.arange(len(scores)) - begin[seq]] + rank[seq]
    e = np.empty((len(scores), labels), dtype=np.float64)
    e[place] = np.exp(scores - scores.max(1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    fore, back = np.empty_like(e), np.ones_like(e)
    expected = np.zeros_like(move)
    for t in range(steps):
        now = slice(offset[t], offset[t + 1])
        x = e[now]
        if t:
            x = (fore[offset[t - 1] : offset[t - 1] + alive[t]] @ move) * x
        fore[now] = x / x.sum(1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        n = alive[t + 1]
        nxt = back[offset[t + 1] : offset[t + 1] + n] * e[offset[t + 1] : offset[t + 1] + n]
        x = nxt @ move.T
        at = slice(offset[t], offset[t] + n)
        a = fore[at]
        norm = (a * x).sum(1, keepdims=True)
        expected += (a / norm).T @ nxt
        back[at] = x / x.sum(1, keepdims=True)
    p = fore * back
    p /= p.sum(1, keepdims=True)
    return p[place], expected * move


class Field:
    """A fitted field: labels, feature weights, transitions."""

    def __init__(self, labels: list[str], weights: np.ndarray, transitions: np.ndarray):
        self.labels, self.weights, self.transitions = labels, weights, transitions


def fit(samples: list[tuple[str, str]], epochs: int = 3, rate: float = 0.4, batch: int = 64, seed: int = 3) -> Field:
    """Fit on (text, label) pairs by AdaGrad on the conditional likelihood.

    Every text is cut into runs of 4 to 40 words; runs of all texts are
    shuffled and joined by threes, so sequences switch language.
    """
    labels = sorted({label for _, label in samples})
    index = {x: i for i, x in enumerate(labels)}
    rng = np.random.default_rng(seed)
    runs = []
    for text, label in samples:
        words = [w for w in text.split() if has_letter(w)]
        at = 0
        while at < len(words):
            n = int(rng.integers(4, 41))
            runs.append((words[at : at + n], index[label]))
            at += n
    weights = np.zeros((BUCKETS, len(labels)), dtype=np.float32)
    transitions = np.zeros((len(labels), len(labels)))
    seen_w, seen_t = np.full_like(weights, 1e-2), np.full_like(transitions, 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(runs))
        joined = [order[i : i + 3] for i in range(0, len(order), 3)]
        for lo in range(0, len(joined), batch):
            group = joined[lo : lo + batch]
            words = [w for s in group for r in s for w in runs[r][0]]
            gold = np.array([runs[r][1] for s in group for r in s for _ in runs[r][0]])
            lengths = np.array([sum(len(runs[r][0]) for r in s) for s in group])
            bucket, owner = word_features(words)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            p, moved = marginals(np.add.reduceat(weights[bucket], first, axis=0), lengths, transitions)
            grad = p.copy()
            grad[np.arange(len(gold)), gold] -= 1
            step = np.stack(
                [np.bincount(bucket, weights=grad[owner, k], minlength=BUCKETS) for k in range(len(labels))], axis=1
            ).astype(np.float32) / len(gold)
            seen_w += step * step
            weights -= rate * step / np.sqrt(seen_w)
            ends = np.cumsum(lengths)
            inner = np.ones(len(gold), dtype=bool)
            inner[ends - 1] = False
            pairs = np.flatnonzero(inner)
            actual = np.zeros_like(transitions)
            np.add.at(actual, (gold[pairs], gold[pairs + 1]), 1.0)
            step_t = (moved - actual) / max(1, len(pairs))
            seen_t += step_t * step_t
            transitions -= rate * 5 * step_t / np.sqrt(seen_t)
    return Field(labels, weights, transitions)


class Predictor:
    """Whole-text prediction with a bounded memo of word scores."""

    def __init__(self, field: Field):
        self.field = field
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((1, len(field.labels)), dtype=np.float32)  # row 0: no letter

    def _rows(self, words: list[str]) -> np.ndarray:
        rows = self.rows
        fresh = [w for w in dict.fromkeys(words) if w not in rows]
        if fresh:
            if len(rows) + len(fresh) > CACHE:
                rows.clear()
                self.scores = self.scores[:1]
                fresh = list(dict.fromkeys(words))
            letters = [w for w in fresh if has_letter(w)]
            rows.update(dict.fromkeys(fresh, 0))
            at = len(self.scores)
            rows.update(zip(letters, range(at, at + len(letters)), strict=True))
            parts = [emissions(self.field.weights, letters[i : i + 50_000]) for i in range(0, len(letters), 50_000)]
            self.scores = np.concatenate([self.scores, *parts])
        return np.fromiter(map(rows.__getitem__, words), dtype=np.int64, count=len(words))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(labels, mean probability of the label) of whole texts."""
        split = [t.split() for t in texts]
        row = self._rows([w for ws in split for w in ws])
        doc = np.repeat(np.arange(len(texts)), [len(ws) for ws in split])
        kept = row > 0
        row, doc = row[kept], doc[kept]
        labels = self.field.labels
        out, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not len(row):
            return out, score
        docs, lengths = np.unique(doc, return_counts=True)
        p, _ = marginals(self.scores[row], lengths, self.field.transitions)
        first = np.cumsum(lengths) - lengths
        mean = np.add.reduceat(p, first, axis=0) / lengths[:, None]
        best = mean.argmax(1)
        for d, b, m in zip(docs.tolist(), best.tolist(), mean, strict=True):
            out[d], score[d] = labels[b], min(1.0, float(m[b]))
        return out, score


def training_rows(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_label: int, max_rows: int
) -> list[tuple[str, str]]:
    """The bounded sample: up to ``per_label`` documents of each label, drawn by
    a hash of the id; fewer of each, but one at least, if labels are so many
    that this would be more than ``max_rows``. Ids are drawn first; texts are
    read for those only."""
    known = docs.where(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))
    ).select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    labels = known.select("_lang").distinct().count()
    if not labels:
        return []
    per_label = max(1, min(per_label, max_rows // labels))
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id")
    drawn = (
        known.select("_id", "_lang")
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= per_label)
        .select("_id")
        .distinct()
    )  # at most max_rows ids, or one a label
    picked = known.join(F.broadcast(drawn), "_id").select("_id", "_lang", "_text")
    rows = picked.limit(2 * per_label * labels).collect()
    rows.sort(key=lambda r: (str(r["_id"]), r["_lang"], r["_text"]))
    return [(r["_text"], r["_lang"]) for r in rows if has_letter(r["_text"])]


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_label: int = 150,
    max_rows: int = 9600,
    keep: tuple[str, ...] = (),
    names: tuple[str, str, str] = ("held_out", "lang_pred", "score"),
) -> DataFrame:
    """Language of every whole text: id, held_out, lang_pred, score; or, with
    ``keep``, those columns of ``docs`` instead of the id. ``names`` are the
    names of the three added columns.

    Learns from rows with a text and a label whose id is not held out, at most
    ``per_label`` documents per label and about ``max_rows`` in all (the
    documented bound of the fit); every label that has such a row is learned.
    Prediction sees the text only. A text that is null or has no letter is
    "und" with score 0, as is every text if there is nothing to learn from.
    Repeated rows and null ids are kept; other columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    samples = training_rows(docs, id_col, text_col, lang_col, per_label, max_rows)
    shared = spark.sparkContext.broadcast(fit(samples) if samples else None)

    wanted = list(keep) or [id_col]
    inner = {c: "_text" if c == text_col else f"_keep_{c}" for c in wanted}
    source = docs.select(
        F.col(text_col).alias("_text"),
        held_out(F.col(id_col)).alias("_held"),
        *[F.col(c).alias(n) for c, n in inner.items() if n != "_text"],
    )
    kinds = dict(source.dtypes)
    carried = ["_held", *inner.values()]
    shape = ", ".join(f"`{c}` {kinds[c]}" for c in carried) + ", _label string, _score double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from logwise.llm.pieces import slices

        predictor = Predictor(shared.value) if shared.value is not None else None
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["_text"]]
            for part in slices(texts, 8_000_000):
                out = pdf.iloc[part][carried].copy()
                if predictor is None:
                    out["_label"], out["_score"] = UNDETERMINED, 0.0
                else:
                    out["_label"], out["_score"] = predictor.predict(texts[part])
                yield out

    done = source.mapInPandas(run, shape)
    held, label, score = names
    return done.select(
        *[F.col(n).alias(c) for c, n in inner.items()],
        F.col("_held").alias(held),
        F.col("_label").alias(label),
        F.col("_score").alias(score),
    )
