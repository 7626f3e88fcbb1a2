"""Phrase collocations by direct-address tiles (operator 11).

Words are ranked by frequency within their language, so that a pair of neighbours is a place in a
table whose mass lies near its corner. The table is cut into tiles of TILE by TILE places. Of each
chunk of text, tiles that hold many pairs are counted by a dense numpy bincount over their places;
all other pairs are sorted as coordinates and counted by run lengths. The counts of all chunks are
added up by region of the table, and frequent pairs are ranked by frequency in turn: with their
ranks for rows, and the word that follows for columns, the next round counts phrases of three words
in the same way, and so on.

A chunk is a run of whole pieces of one language; a phrase never crosses pieces. Chunks learn the
ranks of their words, and later of their pairs, from joins: they send each distinct one once, and
get back those that are frequent. So no task holds a vocabulary, and every count is over all texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import mix
from tickloom.llm.order import numbered, ranges_of
from tickloom.session import remove_path, settings, shared_path

LEAST = 10  # occurrences of a candidate
LONGEST = 3  # words
TOP = 2000  # phrases of a language
SHARE = 50  # percent of a candidate's occurrences that a longer one drops it with
UNKNOWN_LANG = "und"
CHUNK_WORDS = 400_000
TILE_BITS = 9
DENSE = 1 << (2 * TILE_BITS - 3)  # pairs that make a tile dense: one for eight places
_CORNER = 64  # tiles a side that are looked at for dense ones
# Capital letters as small ones; ends of pieces as line feeds.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
_FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "8"}


class _Kept:
    """Tables in the shared folder that go when they have been used."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_path(self.spark, name)
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(kept)] = path, kept
        return kept

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            remove_path(self.spark, self.paths.pop(id(table))[0])


def pack(values: np.ndarray) -> bytes:
    """Integers as planes of their bytes, lowest first: the high planes of small numbers compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def unpack(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def pack_codes(codes: np.ndarray) -> bytes:
    """Ascending codes, as their differences."""
    return pack(np.diff(codes, prepend=np.uint64(0)))


def unpack_codes(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw, np.uint64), dtype=np.uint64)


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = made = len(self)
        return made


def _chunks(size: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of (lang, text) to rows of chunks; a task holds 4 * size words at most, and a piece."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        held: dict[str, list[bytes]] = {}
        total = 0

        def row(lang: str) -> pa.RecordBatch:
            nonlocal made, total
            tokens = held.pop(lang)
            total -= len(tokens)
            ids = _Ids({b"\n": 0})  # no word has a line feed
            found = np.fromiter(map(ids.__getitem__, tokens), np.int32, len(tokens))
            counts = np.bincount(found, minlength=len(ids))[1:]
            made += 1
            words = pa.array(list(ids)[1:], pa.binary()).cast(pa.string())
            values = [[first + made], [lang], [words.to_pylist()], [counts.tolist()], [pack(found)]]
            kinds = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
            names = ["chunk", "lang", "words", "counts", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)

        for part in parts:
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                for piece in text.encode("utf-8", "surrogatepass").translate(_BYTES).split(b"\n"):
                    words = piece.split()
                    if words:
                        tokens = held.setdefault(lang, [])
                        tokens += words
                        tokens.append(b"\n")
                        total += len(words) + 1
                        if len(tokens) >= size:
                            yield row(lang)
            while total > 4 * size:
                yield row(max(held, key=lambda k: len(held[k])))
        for lang in list(held):
            yield row(lang)

    return run


def count_codes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes (row << 32 | column), ascending, and how often each occurs."""
    rows, columns = (codes >> np.uint64(32)).astype(np.int64), (codes & np.uint64(0xFFFFFFFF)).astype(np.int64)
    tile_row, tile_column = rows >> TILE_BITS, columns >> TILE_BITS
    corner = (tile_row < _CORNER) & (tile_column < _CORNER)
    tile = np.where(corner, tile_row * _CORNER + tile_column, _CORNER * _CORNER)
    sizes = np.bincount(tile, minlength=_CORNER * _CORNER + 1)[:-1]
    dense = np.flatnonzero(sizes >= DENSE)
    found, counts = [], []
    side, inside = 1 << TILE_BITS, (1 << TILE_BITS) - 1
    for t in dense.tolist():
        own = tile == t
        places = np.bincount((rows[own] & inside) * side + (columns[own] & inside), minlength=side * side)
        at = np.flatnonzero(places)
        row = (at >> TILE_BITS) + t // _CORNER * side
        found.append((row.astype(np.uint64) << np.uint64(32)) | ((at & inside) + t % _CORNER * side).astype(np.uint64))
        counts.append(places[at])
    rest = np.sort(codes[~np.isin(tile, dense)] if len(dense) else codes)
    starts = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]])) if len(rest) else np.zeros(0, np.int64)
    found.append(rest[starts])
    counts.append(np.diff(starts, append=len(rest)))
    codes, totals = np.concatenate(found), np.concatenate(counts).astype(np.int64)
    order = np.argsort(codes, kind="stable")
    return codes[order], totals[order]


def add_up(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, and the sums of their counts."""
    if not len(codes):
        return codes, counts
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[starts], np.add.reduceat(counts, starts)


def buckets_of(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Where codes are added up: by a hash of their region, a few rows of a tile."""
    region = (codes >> np.uint64(36) << np.uint64(32)) | ((codes & np.uint64(0xFFFFFFFF)) >> np.uint64(TILE_BITS))
    return (mix(region) % np.uint64(buckets)).astype(np.int32)


def _next_codes(rows: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """Per position the code of the phrase of n + 1 words there, if its first and its last n are frequent;
    all ones elsewhere. `rows` has the ranks of phrases of n words."""
    out = np.full(len(words), np.uint64(2**64 - 1))
    if len(words) > n:
        head, tail, last = rows[:-n], rows[1:], words[n:]
        good = (head >= 0) & (tail[: len(head)] >= 0) & (last >= 0)
        out[: len(head)][good] = (head[good].astype(np.uint64) << np.uint64(32)) | last[good].astype(np.uint64)
    return out


_NONE = np.uint64(2**64 - 1)


def _ranked_chunk(chunk: int, lang: str, rows: np.ndarray, words: np.ndarray, n: int) -> pa.Table:
    """A chunk with the ranks of its phrases of n words, and the phrases of n + 1 words with their counts."""
    codes = _next_codes(rows, words, n)
    found, counts = count_codes(codes[codes != _NONE])
    values = [pack(rows), pack(words), pack_codes(found), pack(counts.astype(np.uint32))]
    columns = [pa.array([chunk], pa.int64()), pa.array([lang], pa.string()), *[pa.array([v], pa.binary()) for v in values]]
    return pa.table(columns, names=["chunk", "lang", "rows", "ranks", "codes", "counts"])


_CHUNK = "chunk long, lang string, rows binary, ranks binary, codes binary, counts binary"


def _with_word_ranks(chunks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    local = chunks.select("chunk", "lang", F.posexplode("words").alias("local", "word"))
    ranks = local.join(vocabulary.select("lang", "word", "index"), ["lang", "word"]).select(F.col("chunk").alias("of"), "local", "index")

    def rank(chunk: pa.Table, known: pa.Table) -> pa.Table:
        ids = unpack(chunk.column("ids")[0].as_py(), np.int32)
        of_local = np.full(int(ids.max(initial=0)) + 1, -1, np.int32)
        of_local[known.column("local").to_numpy() + 1] = known.column("index").to_numpy()
        words = of_local[ids]
        return _ranked_chunk(chunk.column("chunk")[0].as_py(), chunk.column("lang")[0].as_py(), words, words, 1)

    own = chunks.select("chunk", "lang", "ids")
    return own.groupBy("chunk").cogroup(ranks.groupBy("of")).applyInArrow(rank, _CHUNK)


def _dealt(chunks: DataFrame, buckets: int) -> DataFrame:
    """(lang, bucket, kind, chunk, codes, counts): the phrases of each chunk by bucket."""

    def deal(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for chunk, lang, raw, own in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                codes, counts = unpack_codes(raw), unpack(own, np.uint32)
                bucket = buckets_of(codes, buckets)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
                groups = [order[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
                columns = [
                    pa.array([lang] * len(groups), pa.string()),
                    pa.array([int(bucket[g[0]]) for g in groups], pa.int32()),
                    pa.array([1] * len(groups), pa.int32()),
                    pa.array([chunk] * len(groups), pa.int64()),
                    pa.array([pack_codes(codes[g]) for g in groups], pa.binary()),
                    pa.array([pack(counts[g]) for g in groups], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "kind", "chunk", "codes", "counts"])

    return chunks.select("chunk", "lang", "codes", "counts").mapInArrow(
        deal, "lang string, bucket int, kind int, chunk long, codes binary, counts binary"
    )


def _groups(parts: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[tuple]]]:
    """Rows of sorted batches with the (lang, bucket) that they belong to."""
    for part in parts:
        for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
            yield row[:2], row[2:]


def _frequent(dealt: DataFrame, least: int) -> DataFrame:
    """lang, bucket, code, f of the codes with at least `least` occurrences over all chunks."""
    limit = 1 << 20

    def add(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, codes, counts, held = None, [], [], 0

        def result() -> pa.RecordBatch:
            found, f = add_up(np.concatenate(codes), np.concatenate(counts))
            keep = f >= least
            n = int(keep.sum())
            columns = [
                pa.array([key[0]] * n, pa.string()),
                pa.array([key[1]] * n, pa.int32()),
                pa.array(found[keep].astype(np.int64)),
                pa.array(f[keep].astype(np.int64)),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "code", "f"])

        for own, (_, _, raw, n) in _groups(parts):
            if own != key and codes:
                yield result()
                codes, counts, held = [], [], 0
            key = own
            codes.append(unpack_codes(raw))
            counts.append(unpack(n, np.uint32).astype(np.int64))
            held += len(codes[-1])
            if held > limit:
                merged = add_up(np.concatenate(codes), np.concatenate(counts))
                codes, counts, held = [merged[0]], [merged[1]], 0
        if codes:
            yield result()

    with_order = dealt.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket")
    return with_order.mapInArrow(add, "lang string, bucket int, code long, f long")


def _with_phrase_ranks(chunks: DataFrame, dealt: DataFrame, phrases: DataFrame, n: int) -> DataFrame:
    """Chunks with the ranks of their phrases of n words, of which `phrases` are the frequent ones."""
    known = phrases.groupBy("lang", "bucket").agg(F.sort_array(F.collect_list(F.struct("code", "index"))).alias("own"))

    def packed(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            codes, ids = [], []
            for own in part.column("own"):
                flat = own.values
                codes.append(pack_codes(flat.field("code").to_numpy(zero_copy_only=False).astype(np.uint64)))
                ids.append(pack(flat.field("index").to_numpy(zero_copy_only=False).astype(np.uint32)))
            m = part.num_rows
            columns = [
                part.column("lang"), part.column("bucket"), pa.array([0] * m, pa.int32()), pa.array([0] * m, pa.int64()),
                pa.array(codes, pa.binary()), pa.array(ids, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "kind", "chunk", "codes", "counts"])

    lists = known.mapInArrow(packed, dealt.schema)

    def answer(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, codes, ids = None, None, None
        for own, (kind, chunk, raw, more) in _groups(parts):
            if kind == 0:
                key, codes, ids = own, unpack_codes(raw), unpack(more, np.uint32)
            elif own == key:
                asked = unpack_codes(raw)
                at = np.minimum(np.searchsorted(codes, asked), len(codes) - 1)
                good = codes[at] == asked
                if good.any():
                    values = [[chunk], [pack_codes(asked[good])], [pack(ids[at[good]])]]
                    kinds = [pa.int64(), pa.binary(), pa.binary()]
                    columns = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["chunk", "codes", "ids"])

    asked = dealt.withColumn("counts", F.lit(None).cast("binary")).unionByName(lists)
    together = asked.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket", "kind")
    answers = together.mapInArrow(answer, "chunk long, codes binary, ids binary")

    def rank(chunk: pa.Table, found: pa.Table) -> pa.Table:
        rows, words = (unpack(chunk.column(c)[0].as_py(), np.int32) for c in ("rows", "ranks"))
        codes = _next_codes(rows, words, n - 1)
        new = np.full(len(words), -1, np.int32)
        if found.num_rows:
            known = np.concatenate([unpack_codes(r) for r in found.column("codes").to_pylist()])
            ids = np.concatenate([unpack(r, np.uint32) for r in found.column("ids").to_pylist()])
            order = np.argsort(known)
            known, ids = known[order], ids[order]
            at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
            good = known[at] == codes
            new[good] = ids[at[good]]
        return _ranked_chunk(chunk.column("chunk")[0].as_py(), chunk.column("lang")[0].as_py(), new, words, n)

    own = chunks.select("chunk", "lang", "rows", "ranks")
    return own.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(rank, _CHUNK)


def frequent_phrases(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    lang_col: str = "lang",
    text_col: str = "text",
    chunk_words: int = CHUNK_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of 1 to `longest` words with at least `least` occurrences,
    and (lang, n), the number of words of each language. Both are stored tables.

    A-Z count as small letters. Texts are cut into pieces at . , ; : ! ? and line ends, pieces into words at
    blanks and tabs. A NULL text has no words; rows without a language are of "und".
    """
    spark = docs.sparkSession
    kept = _Kept(spark)
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "chunk long, lang string, words array<string>, counts array<long>, ids binary"
    raw = kept.put(texts.mapInArrow(_chunks(chunk_words), schema), "chunks")
    totals = kept.put(
        raw.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, n: s + n).alias("n")).groupBy("lang").agg(F.sum("n").alias("n")),
        "totals",
    )
    each = raw.select("lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("n"))))
    common = kept.put(each.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least), "words")
    vocabulary = kept.put(numbered(common, ["lang", F.desc("f"), "word"], ranges_of(common), "lang").select("lang", "word", "f", "index"), "vocabulary")
    found = [vocabulary.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "f", "index")]
    with settings(spark, _FEW_ROWS):
        chunks = kept.put(_with_word_ranks(raw, vocabulary), "ranked")
    kept.drop(raw)
    for n in range(2, longest + 1):
        with settings(spark, _FEW_ROWS):
            dealt = _dealt(chunks, buckets)
        with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}):
            frequent = kept.put(_frequent(dealt, least), "frequent")
        ranked = kept.put(
            numbered(frequent, ["lang", F.desc("f"), "code"], ranges_of(frequent), "lang").select("lang", "bucket", "code", "f", "index"), "phrases"
        )
        head = found[-1].select("lang", F.col("phrase").alias("head"), F.col("index").alias("row"))
        last = vocabulary.select("lang", "word", F.col("index").alias("column"))
        named = (
            ranked.withColumn("row", F.shiftrightunsigned("code", 32))
            .withColumn("column", F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)))
            .join(head, ["lang", "row"])
            .join(last, ["lang", "column"])
        )
        found.append(
            kept.put(named.select("lang", F.concat_ws(" ", "head", "word").alias("phrase"), F.lit(n).alias("words"), "f", "index"), "named")
        )
        if n < longest:
            with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "64"}):
                following = kept.put(_with_phrase_ranks(chunks, dealt, ranked, n), "ranked")
            kept.drop(chunks)
            chunks = following
    kept.drop(chunks)
    out = found[0]
    for table in found[1:]:
        out = out.unionByName(table)
    return out.drop("index"), totals


def score_of(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact for counts up to 10**15."""
    a, left, right = (f"cast({c} as decimal(16,0))" for c in (a, left, right))
    return F.expr(f"cast(({a} * {a} * cast(1000000 as decimal(7,0))) div ({left} * {right}) as bigint)")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, share: int = SHARE, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language.

    Candidates are phrases of 2 to `longest` words with at least `least` occurrences (a). Cutting one in
    two gives l and r, the occurrences of its parts, and floor(1000000 * a * a / (l * r)); the lowest score
    counts, of equal ones that of the shortest first part. A candidate inside a longer one that has at least
    `share` percent of its occurrences is dropped. Order: score, a (both descending), phrase (by bytes).
    Scores are exact for up to 10**15 occurrences. Other options are those of frequent_phrases().
    """
    phrases, totals = frequent_phrases(docs, least, longest, **options)
    spark = docs.sparkSession
    kept = _Kept(spark)
    candidates = phrases.where("words > 1")
    word = F.split("phrase", " ")

    def joined(start, length):
        return F.array_join(F.slice(word, start, length), " ")

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "words", F.col("f").alias("a"), "k", joined(F.lit(1), F.col("k")).alias("head"), joined(F.col("k") + 1, F.col("words")).alias("tail")
    )
    parts = phrases.where(F.col("words") < longest).select("lang", "phrase", "f")
    scored = cuts.join(parts.toDF("lang", "head", "l"), ["lang", "head"]).join(parts.toDF("lang", "tail", "r"), ["lang", "tail"])
    scored = scored.withColumn("score", score_of("a", "l", "r"))
    best = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Candidates inside longer ones.
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: joined(i, m)),
        )
    )
    longer = phrases.where("words > 2").select("lang", "f", F.explode(F.array_distinct(inner)).alias("phrase"))
    outer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("outer"))
    left = best.join(outer, ["lang", "phrase"], "left").where(F.col("outer").isNull() | (100 * F.col("outer") < share * F.col("a")))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    ranks = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    flat = left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # So that each task passes on no more than `top` rows of a language.
    with settings(spark, {"spark.sql.optimizer.windowGroupLimitThreshold": str(top)}):
        first = kept.put(flat.withColumn("rank", ranks).where(F.col("rank") <= top), "first")
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
