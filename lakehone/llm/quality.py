"""Quality rules: counts of words, lines and repeats, and a hashed n-gram log-likelihood ratio."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, lower_batches, mix64, rolled, small_batches

GRAM, BUCKETS = 4, 1 << 16
#: Ids of documents labelled 1 that tasks hold, 8 bytes each; with more of them, or ids that are no integers, texts are shuffled to their labels.
HELD, INTEGERS = 8_000_000, ("tinyint", "smallint", "int", "bigint")
SPACES = bytes(i for i in range(256) if i == 0x20 or 9 <= i <= 13)


def grams(raw: bytes) -> np.ndarray:
    """Buckets of all n-grams of bytes (short texts: of the whole text, padded)."""
    b = np.frombuffer(raw.ljust(GRAM, b"\0"), np.uint8).astype(np.uint32)
    key = b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)
    return (key * np.uint32(0x9E3779B1)) >> np.uint32(16)


def base_counts(text: str | None, hashes: WordHashes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()
    if not words:
        return 0, 0, 0, 0, 0
    chars = len(text) - (len(raw) - len(raw.translate(None, SPACES)))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    repeat = 0
    if len(words) >= 3:
        _, at, many = np.unique(rolled(hashes.of(words), 3), return_inverse=True, return_counts=True)
        # A window covers its word and the next two.
        start = np.concatenate([many[at] > 1, [False, False]])
        cover = start.copy()
        cover[1:] |= start[:-1]
        cover[2:] |= start[:-2]
        repeat = int(cover.sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat


def counted(docs: DataFrame, ids: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """N-grams by bucket, of all documents and of those whose doc_id is one of ids (sorted)."""
    shared = None if ids is None else docs.sparkSession.sparkContext.broadcast(ids)

    def count(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            known = np.zeros(len(texts), bool)
            if shared is not None and len(shared.value):
                own = batch.column("doc_id")
                values = own.fill_null(0).to_numpy()
                at = np.minimum(np.searchsorted(shared.value, values), len(shared.value) - 1)
                known = (shared.value[at] == values) & own.is_valid().to_numpy(zero_copy_only=False)
            for to, part in zip(total, (~known, known)):
                found = [grams(t.encode()) for t, here in zip(texts, part.tolist()) if here and t]
                if found:
                    to += np.bincount(np.concatenate(found), minlength=BUCKETS)
        total[0] += total[1]
        there = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(there), *(pa.array(x[there]) for x in total)], ["bucket", "n", "known"])

    # At most BUCKETS rows come to the driver.
    with small_batches(docs.sparkSession):
        rows = docs.select("text") if ids is None else docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        found = rows.mapInArrow(count, "bucket long, n long, known long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("known").alias("known")).toArrow()
    out = np.zeros((2, BUCKETS), np.int64)
    for to, name in zip(out, ("n", "known")):
        to[found["bucket"].to_numpy()] = found[name].to_numpy()
    return out[0], out[1]


def agreed(labels: DataFrame) -> DataFrame:
    """doc_id, quality of every document labelled 0 or 1, where all labels of the document say the same."""
    ids = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("high"))
    return ids.where("quality = high and quality in (0, 1)").select("doc_id", "quality")


def labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of docs that have a label, with it: labels grow with the documents, so both are shuffled, and the hash table is of labels."""
    return docs.join(known.hint("shuffle_hash"), "doc_id")


def scored(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, score of every document with a text."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        ratio = shared.value
        for batch in batches:
            found = [float(ratio[grams(t.encode())].mean()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").where("doc_id is not null and text is not null").mapInArrow(run, f"doc_id {kind}, score double")


def threshold(rows: DataFrame) -> float:
    """Where fewest of all rows (score, quality 0 or 1) are wrong, one of quality 1 counting ten times, in the middle of the widest gap, of equal ones the lowest; without quality 0 nothing is below it.

    Scores are dealt to tasks by range; of each range come its ends, its sums and its best gap, so that no list of scores reaches the driver.
    """
    names = ["first", "last", "cost", "bad", "least", "width", "edge"]

    def run(batches):
        # Costs are relative to the start of the range: each 1 below an edge adds ten, each 0 takes one off.
        first = last = None
        cost, bad, best = 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            at, good, poor = (batch.column(i).to_numpy() for i in range(3))
            step = 10 * good - poor
            before = cost + np.concatenate([[0], np.cumsum(step)[:-1]])
            low = np.concatenate([[at[0] if last is None else last], at[:-1]])
            i = np.arange(len(at))[int(last is None) :]
            if len(i):
                i = i[before[i] == before[i].min()]
                k = i[np.argmax((at - low)[i])]
                best = min(filter(None, [best, (int(before[k]), float(low[k] - at[k]), between(low[k], at[k]))]))
            first = float(at[0]) if first is None else first
            last, cost, bad = float(at[-1]), cost + int(step.sum()), bad + int(poor.sum())
        if first is not None:
            row = (first, last, cost, bad, *(best or (None, None, None)))
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()])], names)

    distinct = rows.groupBy("score").agg(F.sum(F.expr("if(quality = 1, 1L, 0L)")).alias("good"), F.sum(F.expr("if(quality = 0, 1L, 0L)")).alias("poor"))
    parts = distinct.repartitionByRange("score").sortWithinPartitions("score").mapInArrow(run, "first double, last double, cost long, bad long, least long, width double, edge double")
    ranges = sorted(tuple(r) for r in parts.collect())
    if not sum(r[3] for r in ranges):
        return -np.inf
    # Widths are negative: the least of equal costs is the widest gap.
    found, cost, last = [(0, 0.0, ranges[0][0] - 1)], 0, None
    for first, end, total, _, least, width, edge in ranges:
        if last is not None:
            found.append((cost, last - first, between(last, first)))
        if least is not None:
            found.append((cost + least, width, edge))
        cost, last = cost + total, end
    return float(min([*found, (cost, 0.0, last + 1)])[2])


def between(low: float, high: float) -> float:
    """The middle, and the higher one of neighbouring numbers, for ties with the threshold are kept."""
    middle = (float(low) + float(high)) / 2
    return middle if middle > low else float(high)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """The log ratio of each bucket, and the threshold of a document's mean.

    Raw counts cover all documents, the target's all that are labelled 1.  The threshold lies between the scores of all documents
    labelled 0 and 1: where fewest are wrong, a good document counting ten times, in the middle of the widest gap.  Without labels of
    either kind nothing is rejected.
    """
    known = agreed(labels)
    good = known.where("quality = 1").select("doc_id")
    if all(df.schema["doc_id"].dataType.simpleString() in INTEGERS for df in (docs, labels)) and good.count() <= HELD:
        raw, target = counted(docs, np.sort(good.select(F.col("doc_id").cast("long")).toArrow()["doc_id"].to_numpy()))
    else:
        raw, target = counted(docs)[0], counted(labelled(docs.select("doc_id", "text").where("text <> ''"), good))[0]
    if not target.sum():
        return np.zeros(BUCKETS), -np.inf
    p = (target + 0.5) / (target.sum() + 0.5 * BUCKETS)
    q = (raw + 0.5) / (raw.sum() + 0.5 * BUCKETS)
    ratio = np.log(p / q)
    with small_batches(docs.sparkSession):
        return ratio, threshold(labelled(scored(docs, ratio), known))


def assess(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score of every document.

    With `keep`, the rows of docs that are kept, with these columns.  A null or blank text has no words, fails the base rule and is not
    kept; ties with the threshold are kept; rows that repeat, repeat; other columns are ignored; labels may be empty.
    """
    lower_batches(docs.sparkSession)
    ratio, least = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        hashes, ratio = WordHashes(), shared.value
        for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            out = []
            for text in batch.column("text").to_pylist():
                n, chars, symbols, lines, repeat = base_counts(text, hashes)
                score = float(ratio[grams(text.encode())].mean()) if text else 0.0
                failed = n < 50 or 100 * repeat > 50 * n
                out.append((n, chars, symbols, lines, repeat, failed, not failed and score >= least, score))
            cols = list(zip(*out)) or [()] * 8
            if keep is not None:
                yield batch.filter(pa.array(cols[6], pa.bool_()))
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.bool_()), pa.array(cols[6], pa.bool_()), pa.array(cols[7], pa.float64())], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"])

    if keep is not None:
        part = docs.select(keep)
        return part.mapInArrow(run, part.schema)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double")
