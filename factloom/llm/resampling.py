"""Importance resampling of documents towards a target corpus, by hashed word n-gram features.

1. Each block of texts (``BLOCK_BYTES``, one long text at least) has a dictionary of its own: its words become small integers, its n-grams tuples of
   them, and every document a list of (n-gram, count).  A block names each of its distinct n-grams once, so what is shuffled later grows with the
   distinct n-grams of the blocks and not with the tokens, and no word has more than one row a block.
2. The corpus dictionary maps each distinct word to an integer id; the blocks' tuples are rewritten to tuples of these ids. A tuple of one word is its entry in the dictionary.
3. Every distinct tuple of the corpus is written out as text once and hashed once: crc32 of its UTF-8 bytes modulo ``buckets``.
4. Counts by bucket, of the documents and of the target, give each bucket's gain (``buckets`` numbers, the only table that is sent to all tasks), and the
   buckets are joined back to the blocks, where a document's weight is the floored mean of its features' gains.
5. Gumbel noise from sha256 of the id makes the highest scores a draw without replacement.  Scores are whole numbers within about +-200,000, so a count by score
   gives the cut and the rank of each score; only drawn rows are ordered, within their score.  One score holds at most some 0.04 % of the rows of distinct ids;
   rows that repeat an id are counted before they are ordered and spread by SALT.

Defined results: null and empty texts have no features and weight 0; texts of any length are read whole; repeated rows are documents of their own; a null id takes the noise
of an empty id and follows all others in a tie; of rows with equal score and id those with fewer features come first; an empty target has counts of 0; an empty table gives an
empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string
from pyspark.sql.window import Window

from factloom.llm import textbatch as tb
from factloom.llm.common import arrow_map
from factloom.storage import drop_materialized, materialize

MAX_N, BUCKETS, SEED, PERCENT, MIN_WORDS = 1, 10_000, 2024, 10, 20
#: Text of a block: the larger, the fewer rows name a word again; a task holds one at a time.
BLOCK_BYTES = 8 << 20
#: Rows that repeat one id are counted in so many parts.
SALT = 256
#: Word characters, as bytes of UTF-8: digits, small letters, and all beyond ASCII.
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True

_FIELDS = "block long, target boolean, pos int, n_words long, n_features long, grams array<int>, counts array<int>, gram int, parts array<int>, word string, n long"


def _local(s: tb.Slice, max_n: int) -> tuple[pa.Array, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """A slice's distinct words, each text's number of words, and for each n (row, n-gram number, its word numbers): n-grams are numbered on from the words."""
    inside = _INSIDE[s.data]
    start, end, row = tb.runs(s, inside)
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    coded = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(s.data[inside])).dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64)
    size = len(coded.dictionary)
    out = [(row, ids, np.arange(size)[:, None])]
    code, first, parts = ids, size, np.arange(size)[:, None]  # code: each window's place in parts
    for n in range(2, max_n + 1):
        m = max(len(ids) - n + 1, 0)
        at = np.flatnonzero(row[:m] == row[n - 1 :]) if m else np.zeros(0, np.int64)
        pair, back = np.unique(code[at] * max(size, 1) + ids[at + n - 1], return_inverse=True)
        parts = np.column_stack([parts[pair // max(size, 1)], pair % max(size, 1)])
        out.append((row[at], first + back, parts))
        code = np.zeros(len(ids), np.int64)
        code[at] = back
        first += len(pair)
    return coded.dictionary, np.bincount(row, minlength=s.rows), out


def _counted(row: np.ndarray, gram: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds by row, n-gram and count of each distinct (row, n-gram)."""
    span = int(gram.max()) + 1 if len(gram) else 1
    key, n = np.unique(row * span + gram, return_counts=True)
    return np.searchsorted(key // span, np.arange(rows + 1)), key % span, n


def _columns(rows: int, schema: pa.Schema, **given) -> pa.RecordBatch:
    """A batch of ``rows`` rows; columns that are not given are null."""
    return pa.RecordBatch.from_arrays([given[f.name].cast(f.type) if f.name in given else pa.nulls(rows, f.type) for f in schema], schema=schema)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of as many batches as make a block, about."""
    held, size = [], 0
    for rb in batches:
        held.append(rb)
        size += rb["text"].nbytes
        if size >= BLOCK_BYTES:
            yield tuple(pa.concat_arrays([b[c] for b in held]) for c in ("id", "text"))
            held, size = [], 0
    if held:
        yield tuple(pa.concat_arrays([b[c] for b in held]) for c in ("id", "text"))


def block_features(docs: DataFrame, max_n: int = MAX_N, target: bool = False, id_column: str = "doc_id") -> DataFrame:
    """Rows of blocks: one a document (gram null) with its distinct n-grams' numbers and counts, and one a distinct n-gram with its count in the block and
    its ``word`` or, for longer ones, the numbers of its words (``parts``)."""
    id_type = docs.schema[id_column].dataType
    schema = StructType([StructField("id", id_type), *_parse_datatype_string(_FIELDS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, done = to_arrow_schema(schema), 0
        for ids, texts in _gathered(batches):
            for s in tb.slices(texts, BLOCK_BYTES):
                s = s.lower()
                words, n_words, levels = _local(s, max_n)
                row, gram = np.concatenate([x[0] for x in levels]), np.concatenate([x[1] for x in levels])
                bounds, at, n = _counted(row, gram, s.rows)
                block = (TaskContext.get().partitionId() << 33) + 2 * done + target
                done += 1
                same = lambda k, v, kind: pa.array(np.full(k, v), kind)
                lists = lambda v, kind: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v, kind))
                yield _columns(s.rows, out, id=ids.slice(s.first, s.rows), block=same(s.rows, block, pa.int64()), target=same(s.rows, target, pa.bool_()), pos=pa.array(np.arange(s.rows), pa.int32()),
                               n_words=pa.array(n_words), n_features=pa.array(np.bincount(row, minlength=s.rows)), grams=lists(at, pa.int32()), counts=lists(n, pa.int32()))
                total = np.bincount(gram, minlength=len(words))
                first = 0
                for k, (_, _, parts) in enumerate(levels):
                    m = len(parts)
                    what = {"word": words} if k == 0 else {"parts": pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * (k + 1), pa.int32()), pa.array(parts.ravel(), pa.int32()))}
                    if m:
                        yield _columns(m, out, block=same(m, block, pa.int64()), target=same(m, target, pa.bool_()), gram=pa.array(np.arange(first, first + m), pa.int32()), n=pa.array(total[first : first + m]), **what)
                    first += m

    return arrow_map(docs.select(F.col(id_column).alias("id"), "text"), run, schema)


def _sums() -> list[Column]:
    of = lambda target: F.coalesce(F.sum(F.when(F.col("target") == target, F.col("n"))), F.lit(0).cast("long"))
    return [of(False).alias("s"), of(True).alias("t")]


def _bucket(text: Column, buckets: int) -> Column:
    return (F.crc32(text.cast("binary")) % buckets).cast("int").alias("bucket")


def word_dictionary(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(word, word_id, s, t, bucket): an integer for each distinct word, which is the tuple of one word as well, hence its counts and its hash.

    Materialise it before use, since the numbers depend on the order of the rows.
    """
    words = features.where(F.col("word").isNotNull()).groupBy("word").agg(*_sums())
    return words.select("word", F.monotonically_increasing_id().alias("word_id"), "s", "t", _bucket(F.col("word"), buckets))


def longer_tuples(features: DataFrame, dictionary: DataFrame, max_n: int = MAX_N) -> DataFrame:
    """(block, target, gram, n, i1, i2, ...): each block's distinct n-grams of two words and more as tuples of word ids; places beyond the n-gram's end are null."""
    place = features.where(F.col("word").isNotNull()).select("block", F.col("gram").alias("part"), "word").join(dictionary.select("word", "word_id"), "word").select("block", "part", "word_id")
    longer = features.where(F.col("parts").isNotNull()).select("block", "target", "gram", "n", F.posexplode("parts").alias("at", "part"))
    ids = [F.max(F.when(F.col("at") == k, F.col("word_id"))).alias(f"i{k + 1}") for k in range(max_n)]
    return longer.join(place, ["block", "part"]).groupBy("block", "target", "gram", "n").agg(*ids)


def hashed_tuples(tuples: DataFrame, dictionary: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """(i1, i2, ..., s, t, bucket): every distinct tuple once, its counts in the documents and the target, and the bucket of its text's bytes."""
    ids = [f"i{k + 1}" for k in range(max_n)]
    spelled = tuples.groupBy(*ids).agg(*_sums())
    for k in ids:
        spelled = spelled.join(dictionary.select(F.col("word_id").alias(k), F.col("word").alias(f"w_{k}")), k, "left")
    return spelled.select(*ids, "s", "t", _bucket(F.concat_ws(" ", *[f"w_{k}" for k in ids]), buckets))  # leaves out nulls


def bucket_gains(hashed: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket, used or not, from (bucket, s, t) of all tuples."""
    used = hashed.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    totals = used.agg(F.coalesce(F.sum("s"), F.lit(0)).cast("double").alias("all_s"), F.coalesce(F.sum("t"), F.lit(0)).cast("double").alias("all_t"))
    each = hashed.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(used, "bucket", "left").join(F.broadcast(totals))  # one row
    ratio = (zero("t") + 1) * (F.col("all_s") + buckets) / ((zero("s") + 1) * (F.col("all_t") + buckets))
    return each.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def _weigh(documents: DataFrame, gains_of: DataFrame, id_type, gains: np.ndarray) -> DataFrame:
    """(id, pos, n_words, n_features, weight) from a block's documents and its n-grams' buckets; both sides are as large as a block."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([StructField("id", id_type), *_parse_datatype_string("pos int, n_words long, n_features long, weight long").fields])

    def run(docs: pa.Table, grams: pa.Table) -> pa.Table:
        sizes = np.asarray(pc.list_value_length(docs["grams"]), np.int64)
        at, n = np.asarray(pc.list_flatten(docs["grams"]), np.int64), np.asarray(pc.list_flatten(docs["counts"]), np.int64)
        gain = np.zeros(grams.num_rows, np.int64)
        gram, bucket = np.divmod(np.asarray(grams["gram_bucket"]), len(gains))
        gain[gram] = gains[bucket]
        ends = np.cumsum(sizes)
        run_sum = np.concatenate([[0], np.cumsum(gain[at] * n)])
        total = run_sum[ends] - run_sum[ends - sizes]
        features = np.asarray(docs["n_features"], np.int64)
        weight = np.where(features > 0, total // np.maximum(features, 1), 0)
        return pa.Table.from_arrays([docs["id"], docs["pos"], docs["n_words"], docs["n_features"], pa.array(weight)], schema=to_arrow_schema(schema))

    return documents.groupBy("of_block").cogroup(gains_of.groupBy("block")).applyInArrow(run, schema)


def gumbel(id_column: str | Column = "doc_id", seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln(u))) of a uniform u from the id and the seed."""
    c = F.col(id_column) if isinstance(id_column, str) else id_column
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, id_column: str = "doc_id") -> DataFrame:
    """(id, pos, n_words, n_features, weight) of every row of ``docs``; ``target`` needs a column text only. pos is the row's place in its block."""
    aimed = block_features(target.select(F.lit(None).cast(docs.schema[id_column].dataType).alias("id"), "text"), max_n, True, "id")
    features = materialize(block_features(docs, max_n, False, id_column).unionByName(aimed), "features", "zstd")
    dictionary = materialize(word_dictionary(features, buckets), "dictionary")
    words = features.where(F.col("word").isNotNull() & ~F.col("target")).select("block", "gram", "word")
    counts, back, used = dictionary.select("bucket", "s", "t"), words.join(dictionary.select("word", "bucket"), "word").select("block", "gram", "bucket"), [features, dictionary]
    if max_n > 1:
        tuples = materialize(longer_tuples(features, dictionary, max_n), "tuples")
        hashed = materialize(hashed_tuples(tuples, dictionary, max_n, buckets), "hashed")
        same = [tuples[f"i{k + 1}"].eqNullSafe(hashed[f"i{k + 1}"]) for k in range(max_n)]
        back = back.unionByName(tuples.where(~F.col("target")).join(hashed, same).select("block", "gram", "bucket"))
        counts, used = counts.unionByName(hashed.select("bucket", "s", "t")), [*used, tuples, hashed]
    gains = np.zeros(buckets, np.int64)
    for r in bucket_gains(counts, buckets).toLocalIterator():  # as many rows as buckets
        gains[r["bucket"]] = r["gain"]
    own = features.where(F.col("gram").isNull() & ~F.col("target")).select(F.col("block").alias("of_block"), "id", "pos", "n_words", "n_features", "grams", "counts")
    back = back.select("block", (F.col("gram").cast("long") * buckets + F.col("bucket")).alias("gram_bucket"))  # a narrow row
    weighed = materialize(_weigh(own, back, docs.schema[id_column].dataType, gains), "weights")
    for t in used:
        drop_materialized(t)
    return weighed


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, n_features, weight, score, rank): the rows of ``scored`` (id, pos, n_words, n_features, weight, score) with the ranks of the drawn ones."""
    able = F.coalesce(F.col("n_words") >= min_words, F.lit(False))
    by_score = scored.where(able).groupBy("score").agg(F.count("*").alias("c"))  # a few hundred thousand whole numbers at most
    wide = Window.orderBy(F.col("score").desc())
    above = by_score.select("score", (F.sum("c").over(wide.rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")).alias("above"), F.floor(percent * F.sum("c").over(wide.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) / 100).alias("most"))
    cut = F.broadcast(above.where(F.col("above") < F.col("most")))
    marked = scored.withColumn("key", F.when(able, F.col("score"))).join(cut.withColumnRenamed("score", "key"), "key", "left")
    rest = marked.where(F.col("above").isNull()).select("id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    same = marked.where(F.col("above").isNotNull()).groupBy("score", "id", "n_features", "weight", "above", "most", (F.col("pos") % SALT).alias("salt")).agg(F.count("*").alias("c"))
    order = Window.partitionBy("score").orderBy(F.col("id").asc_nulls_last(), "n_features", "weight", "salt").rowsBetween(Window.unboundedPreceding, 0)
    ends = same.withColumn("end", F.col("above") + F.sum("c").over(order))
    rank = ends.select("id", "n_features", "weight", "score", "most", F.explode(F.expr("sequence(end - c + 1, end)")).alias("rank"))
    return rest.unionByName(rank.select("id", "n_features", "weight", "score", F.when(F.col("rank") <= F.col("most"), F.col("rank")).alias("rank")))


def resample(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, min_words: int = MIN_WORDS, id_column: str = "doc_id") -> DataFrame:
    """id, n_features, weight, score and rank of every row of ``docs``; rank is null for rows that are not drawn."""
    scored = weigh(docs, target, max_n, buckets, id_column).withColumn("score", F.col("weight") + gumbel("id", seed))
    return draw(scored, percent, min_words).withColumnRenamed("id", id_column)


#: SQL of resample() with the default parameters. crc32 is a fold over a word's bytes with the table of the reflected polynomial.
SQL = r"""
WITH crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce([n] || list_transform(range(8), lambda z: 0), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
w AS (
  SELECT k, doc_id, unnest(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS word
  FROM (SELECT 1 AS k, doc_id, text FROM documents UNION ALL SELECT 2, NULL, text FROM benchmark)),
f AS (SELECT k, doc_id, word, count(*) AS n FROM w GROUP BY ALL),
d AS (SELECT word, sum(CASE WHEN k = 1 THEN n ELSE 0 END) AS s, sum(CASE WHEN k = 2 THEN n ELSE 0 END) AS t, hex(word) AS x FROM f GROUP BY word),
b AS (
  SELECT word, s, t, xor(list_reduce([4294967295] || list_transform(range(CAST(length(x) // 2 AS BIGINT)), lambda i: CAST('0x' || x[2 * i + 1 : 2 * i + 2] AS BIGINT)), lambda c, y: xor(c >> 8, tab[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM d, crc_table),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((sum(t) + 1.0::DOUBLE) * ((SELECT sum(s) FROM b) + 10000.0::DOUBLE) / ((sum(s) + 1.0::DOUBLE) * ((SELECT sum(t) FROM b) + 10000.0::DOUBLE)))) AS BIGINT) AS gain
  FROM b GROUP BY bucket),
v AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight FROM f JOIN b USING (word) JOIN g USING (bucket) WHERE k = 1 GROUP BY doc_id),
o AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN v USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r, floor(10 * count(*) OVER (PARTITION BY n_features >= 20) / 100) AS most FROM o)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= most THEN r END AS rank FROM r
"""
