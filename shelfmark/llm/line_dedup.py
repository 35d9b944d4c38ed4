"""Line dedup: repeated runs of lines, by a suffix array over line ids.

Lines become ids; prefix doubling ranks the line sequences that start at each
position by their first 1, 2, 4, ... lines, each round as a distributed sort of
(rank, rank 2^j lines on).  Sequences that share their first k lines are an interval
of the suffix array whose longest common prefix is at least k; two overlapping powers
of two name it: (k, rank at its start, rank 2^j before its end).  Within an interval
that holds ``min_words`` words or more, the first position stays and the lines of
later copies are deleted.

A line is deleted if some repeated run of ``min_words`` words or more covers it that
has an earlier copy.  Any such run covers the line by a shortest run of that many
words that starts or ends within it, so only shortest runs from each position forward
and backward are looked up, and at most log2(min_words) rounds are needed.

Defined results: lines are cut at "\\n" and compared without outer white space; blank
lines belong to no run, do not break one and stay; null and empty texts have no lines.
Documents are ordered by doc_id (null first), then by text hash; rows equal in both are
one document, and all of them get its result.  A copy that overlaps the first one in
the same document stays.  Columns other than doc_id and text are passed through by
``dedup_lines`` whatever their names are.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_dir, written

MIN_WORDS = 50


def _text_hash() -> Column:
    """Tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _line_rows(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: doc_id, th (text hash), seq, h1, h2, w (words)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def lines(batches):
        for batch in batches:
            rows, at = [], []
            for i, text in enumerate(batch.column("text")):
                text, seq = text.as_py() or "", 0
                for line in text.split("\n"):
                    words = len(line.split())
                    if words:
                        h = xxhash.xxh3_128_intdigest(line.strip().encode("utf-8", "surrogatepass"))
                        rows.append((seq, (h >> 64) - 2**63, (h & 2**64 - 1) - 2**63, words))
                        at.append(i)
                        seq += 1
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("th").take(at), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "th", "seq", "h1", "h2", "w"])

    return docs.select("doc_id", "text", _text_hash().alias("th")).mapInArrow(lines, f"doc_id {kind}, th long, seq long, h1 long, h2 long, w long")


def dense_rank(keys: DataFrame, by: list[str], folder: str) -> DataFrame:
    """``keys`` (distinct in ``by``) with ``rank``: 1, 2, ... in their order, sorted in parts."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = keys.repartitionByRange(n, *by).sortWithinPartitions(*by)
    parts = parts.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    parts = written(parts, folder)
    before, offsets = 0, []
    for part, rows in sorted(map(tuple, parts.groupBy("part").count().collect())):  # one row per part
        offsets.append((part, before + 1))
        before += rows
    offsets = keys.sparkSession.createDataFrame(offsets, "part int, first long")
    return parts.join(F.broadcast(offsets), "part").select(*by, (F.col("at") + F.col("first")).alias("rank"))


def suffix_ranks(rows: DataFrame, levels: int, folder: str) -> DataFrame:
    """``rows`` of repeated lines with r0, r1, ...: rank among the sequences of 2^j lines.

    A rank is null where the sequence is unique, or runs into a line that is.
    """
    where = ["doc_id", "th", "run"]
    ahead = Window.partitionBy(*where).orderBy("seq")
    rows = rows.withColumn("r0", F.col("rank")).drop("rank")
    for j in range(levels):
        follow = F.lead(f"r{j}", 1 << j).over(ahead)
        pairs = written(rows.withColumn("q", F.when(F.col(f"r{j}").isNotNull(), follow)), f"{folder}/pairs{j}")
        several = pairs.filter("q is not null").groupBy(f"r{j}", "q").agg(F.count("*").alias("c")).filter("c > 1").select(f"r{j}", "q")
        ranks = dense_rank(several, [f"r{j}", "q"], f"{folder}/ranks{j}").withColumnRenamed("rank", f"r{j + 1}")
        rows = written(pairs.join(ranks, [f"r{j}", "q"], "left").drop("q"), f"{folder}/rows{j}")
    return rows


def _shortest_runs(words: list[int], ranks: list[list[int]], min_words: int) -> set[tuple[int, int, int, int]]:
    """(start, lines, rank at the start, rank 2^j before the end) of a stretch's shortest runs.

    From each place the shortest run of ``min_words`` words forward and backward; runs
    of which a rank is null are unique and left out.
    """
    n, found = len(words), set()
    upto = [0]
    for w in words:
        upto.append(upto[-1] + w)
    end = 0
    spans = set()
    for s in range(n):
        while end < n and upto[end] - upto[s] < min_words:
            end += 1
        if upto[end] - upto[s] >= min_words:
            spans.add((s, end - s))
    start = 0
    for e in range(1, n + 1):
        while upto[e] - upto[start + 1] >= min_words:
            start += 1
        if upto[e] - upto[start] >= min_words:
            spans.add((start, e - start))
    for s, k in spans:
        j = k.bit_length() - 1
        if (a := ranks[j][s]) is not None and (b := ranks[j][s + k - (1 << j)]) is not None:
            found.add((s, k, a, b))
    return found


def repeated_runs(rows: DataFrame, levels: int, min_words: int) -> DataFrame:
    """(doc_id, th, s, k, a, b): the shortest runs that repeat, by start line and length."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = [f"r{j}" for j in range(levels + 1)]
    stretch = rows.groupBy("doc_id", "th", "run").agg(F.array_sort(F.collect_list(F.struct("seq", "w", *names))).alias("lines"))

    def runs(batches):
        for batch in batches:
            out, at = [], []
            for i, lines in enumerate(batch.column("lines")):
                lines = lines.as_py()
                first = lines[0]["seq"]
                for s, k, a, b in _shortest_runs([x["w"] for x in lines], [[x[n] for x in lines] for n in names], min_words):
                    out.append((first + s, k, a, b))
                    at.append(i)
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("th").take(at), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "th", "s", "k", "a", "b"])

    return stretch.drop("run").mapInArrow(runs, f"doc_id {kind}, th long, s long, k long, a long, b long")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, th, seqs): which non-blank lines to delete (0 is the first), where any are."""
    folder = shared_dir(docs.sparkSession)
    lines = written(_line_rows(docs), f"{folder}/lines")
    several = written(lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "th", "seq")).alias("lo"), F.max(F.struct("doc_id", "th", "seq")).alias("hi")).filter("lo <> hi").select("h1", "h2"), f"{folder}/several")
    ids = dense_rank(several, ["h1", "h2"], f"{folder}/ids")
    rows = lines.join(ids, ["h1", "h2"]).drop("h1", "h2").distinct()
    doc = Window.partitionBy("doc_id", "th").orderBy("seq")
    rows = written(rows.withColumn("run", F.col("seq") - F.row_number().over(doc)), f"{folder}/rows")
    levels = max(min_words, 1).bit_length() - 1
    rows = suffix_ranks(rows, levels, folder)
    runs = written(repeated_runs(rows, levels, min_words), f"{folder}/runs")
    # an interval of the suffix array: the suffixes that share this run; its first place stays
    name = ["k", "a", "b"]
    firsts = runs.groupBy(*name).agg(F.min(F.struct("doc_id", "th", "s")).alias("first"), F.max(F.struct("doc_id", "th", "s")).alias("last")).filter("first <> last").drop("last")
    firsts = written(firsts, f"{folder}/firsts")
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))
    later = runs.join(firsts, name).filter(~own | (F.col("s") >= F.col("first.s") + F.col("k")))
    gone = later.select("doc_id", "th", F.explode(F.sequence("s", F.col("s") + F.col("k") - 1)).alias("seq"))
    return written(gone.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("seq")).alias("seqs")), f"{folder}/gone")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later copies of repeated runs cut from ``text``, and how many went.

    Adds n_lines (not blank), n_deleted and deleted (their numbers among those, joined
    by commas, else null) after the columns given.
    """
    gone = repeated_lines(docs, min_words)
    names = docs.columns
    docs = docs.select(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names) if c != "text"]).alias("row"), F.col("doc_id").alias("d"), _text_hash().alias("h"), F.col("text").alias("t"))
    kind = docs.schema["row"].dataType.simpleString()
    # always by a shuffle: what is deleted grows with the corpus, and small inputs plan alike
    found = docs.join(gone.hint("merge"), docs["d"].eqNullSafe(gone["doc_id"]) & (docs["h"] == gone["th"]), "left").select("row", "t", "seqs")

    def cut(batches):
        for batch in batches:
            kept, n_lines, n_deleted, deleted = [], [], [], []
            for text, seqs in zip(batch.column("t"), batch.column("seqs"), strict=True):
                text, drop = text.as_py(), set(seqs.as_py() or ())
                seq, rest = 0, []
                for line in text.split("\n") if text else []:
                    if not line or line.isspace():
                        rest.append(line)
                        continue
                    if seq not in drop:
                        rest.append(line)
                    seq += 1
                kept.append("\n".join(rest) if drop else text)
                n_lines.append(seq)
                n_deleted.append(len(drop))
                deleted.append(",".join(map(str, sorted(drop))) if drop else None)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_deleted, pa.int64()), pa.array(deleted, pa.string())], ["row", "kept", "n_lines", "n_deleted", "deleted"])

    out = found.mapInArrow(cut, f"row {kind}, kept string, n_lines long, n_deleted long, deleted string")
    columns = [(F.col("kept") if c == "text" else F.col(f"row.c{i}")).alias(c) for i, c in enumerate(names)]
    return out.select(*columns, "n_lines", "n_deleted", "deleted")
