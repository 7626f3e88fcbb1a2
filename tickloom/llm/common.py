"""What several of the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

MASK64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with a NULL text as the empty one; all other columns are left behind."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def batches(
    make: Callable[[pa.RecordBatch], pa.RecordBatch | None], rows: int = 2048
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow from one for batches of at most `rows` rows."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, rows):
                made = make(part.slice(at, rows))
                if made is not None and made.num_rows:
                    yield made

    return run


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(count: int, seed: int) -> np.ndarray:
    """`count` odd 64-bit constants."""
    start = np.uint64((seed * 0x9E3779B97F4A7C15) & MASK64)
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start) | np.uint64(1)


def with_text(docs: DataFrame, text_col: str, out_col: str, kind: T.DataType, make: Callable) -> DataFrame:
    """Add a column that `make` computes from a list of texts; NULL counts as empty.

    All columns travel along; one that is already called `out_col` is replaced. One pass, no
    shuffle.
    """
    kept = docs.drop(out_col)
    text_at = kept.columns.index(text_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(out_col, kind)])
    arrow = to_arrow_type(kind)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 1024):
                some = part.slice(at, 1024)
                made = make([t or "" for t in some.column(text_at).to_pylist()])
                columns = [*some.columns, pa.array(made, arrow)]
                yield pa.RecordBatch.from_arrays(columns, names=[*some.schema.names, out_col])

    return kept.mapInArrow(run, schema)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, sample: int, id_col: str, text_col: str
) -> DataFrame:
    """(doc_id, text, label, weight) of at most `sample` labelled ids, half of them of each class.

    Rows are drawn by a hash of the id. Labels other than 0 and 1, NULL ones among them, count for
    nothing; of several labels of an id the highest counts. The weights restore the mix of all
    labels, so that a probability fitted with them means the same whatever was drawn.
    """
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("doc_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
    )
    draw = F.xxhash64("doc_id", F.lit(11))
    halves = [known.where(F.col("label") == k).orderBy(draw, "doc_id").limit(sample // 2) for k in (0, 1)]
    # The sample's ids are broadcast: their number is bounded by `sample`.
    chosen = F.broadcast(halves[0].unionByName(halves[1]).withColumn("weight", class_weight(known, "label", sample)))
    return keyed_text(docs, id_col, text_col).join(chosen, "doc_id").select("doc_id", "text", "label", "weight")


def class_weight(rows: DataFrame, label_col: str, sample: int) -> Column:
    """What a row counts for where at most sample // 2 rows of each class (0 and 1) are drawn from `rows`.

    That is the share of its class among all rows over its share among the drawn ones: 1 on average,
    and for every row where all are drawn.
    """
    total = {int(r[0]): r[1] for r in rows.groupBy(label_col).count().collect()}
    drawn = {k: min(n, sample // 2) for k, n in total.items()}
    scale = sum(drawn.values()) / max(1, sum(total.values()))
    made = [scale * total[k] / max(1, drawn[k]) if k in total else 1.0 for k in (0, 1)]
    return F.when(F.col(label_col) == 1, made[1]).otherwise(made[0])


def collect_features(
    rows: DataFrame, make: Callable[[str], np.ndarray]
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Feature lists, labels and weights of a labelled sample, in order of id; the texts stay where they are."""

    def extract(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [make(t).astype(np.int32).tobytes() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), part.column(3), pa.array(found, pa.binary())],
                names=["doc_id", "label", "weight", "found"],
            )

    got = rows.mapInArrow(extract, "doc_id long, label int, weight double, found binary").collect()
    got = sorted((r["doc_id"], bytes(r["found"]), r["label"], r["weight"]) for r in got)
    labels, weights = np.array([r[2] for r in got], np.int64), np.array([r[3] for r in got], float)
    return [np.frombuffer(r[1], np.int32) for r in got], labels, weights


def runs(parts: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of sorted batches in runs of equal (non-NULL) integer keys, one run at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for part in parts:
        if not part.num_rows:
            continue
        columns = np.stack([part.column(k).cast(pa.int64()).to_numpy(zero_copy_only=False) for k in keys])
        cuts = [0, *(np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1).tolist(), part.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            own = tuple(columns[:, low].tolist())
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part.slice(low, high - low))
            last = own
    if held:
        yield pa.Table.from_batches(held)
