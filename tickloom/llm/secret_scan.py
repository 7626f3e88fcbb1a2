"""Secret scans with a random forest that removes false positives (operator 7).

Candidates are long runs of token characters, and values of any other characters or length that are
assigned to a keyword or stand as the password of an address. For each, a forest judges its length, its character
transitions, how much of it words of the corpus cover, whether it is part of a path, and the words
beside it. It is trained on labelled findings. Everything runs in the JVM: built-in functions and
the forest of Spark's own library, on DataFrames.

Each place of a value is a finding with its own context. A value counts as a secret in a document if
any of its places there does; redaction replaces every place.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import class_weight
from tickloom.session import store

CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
_KEYWORDS = "passw|pwd|secret|token|api.?key|access.?key|credential|bearer"
_ADDRESS = r"://[^\s/:@]{1,64}:"
_ASSIGNED = rf"""(?i:{_KEYWORDS})[\w-]{{0,24}}["']?\s{{0,2}}(?>:=|=>|[=:])\s{{0,2}}["']?"""
# Values behind a keyword and an assignment, and passwords of addresses.
ASSIGNED = rf"""{_ASSIGNED}[^\s"'<>,;&]{{3,}}[^\s"'<>,;.:)\]}}&]|{_ADDRESS}[^\s/@]{{3,}}(?=@)"""
BEFORE, AFTER = 48, 24
SAMPLE = 8000
TREES, DEPTH = 20, 6
THRESHOLD = 0.5
_BLOCK = 128
FEWEST_DOCUMENTS = 3  # of a word of the dictionary
FEATURES = (
    "length", "digits", "capitals", "turns", "syllables", "variety",
    "covered", "path", "keyword", "assigned", "quoted", "example",
)
# The formats that label findings where nobody has looked at them.
KNOWN_FORMAT = r"^(?:AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$"
KEYWORD = rf"(?i)(?:{_KEYWORDS})[\w-]*\W{{0,4}}$|{_ADDRESS}$"


def _places(text: Column, pattern: str) -> Column:
    """(match, start from 1) of every match of a pattern that matches no empty string.

    The starts are sums of the lengths before them, in blocks, so that a text with many matches
    takes no quadratic time.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(between, 1, F.size(matches)), matches, lambda rest, m: F.struct(F.length(rest).alias("rest"), m.alias("m")))

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda n, s: n + s["rest"] + F.length(s["m"]))

    def of_block(block: Column) -> Column:
        ahead = F.slice(steps, F.lit(1), block * _BLOCK)
        own = F.slice(steps, block * _BLOCK + 1, F.lit(_BLOCK))
        return F.transform(
            F.array(F.struct(total(ahead).alias("ahead"), own.alias("own"))),
            lambda b: F.transform(
                b["own"],
                lambda s, i: F.struct(
                    s["m"].alias("match"),
                    (b["ahead"] + total(F.slice(b["own"], F.lit(1), i)) + s["rest"] + 1).alias("start"),
                ),
            ),
        )[0]

    blocks = F.flatten(F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / _BLOCK).cast("int")), of_block))
    return F.when(F.size(matches) > 0, blocks)


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, value, start (from 1), before, after, digest: a row per place of a candidate value.

    `row` numbers the documents; it tells those apart that share an id or have none.
    NULL and empty texts have none; rows without an id keep NULL. One pass, no shuffle.
    """
    text = F.col("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumns({"row": F.monotonically_increasing_id(), "digest": F.sha2("text", 256)})
    long = F.transform(_places(text, CANDIDATE), lambda p: F.struct(p["match"].alias("value"), p["start"].alias("start")))

    def behind(place: Column) -> Column:
        ahead = F.length(F.regexp_extract(place["match"], f"^(?:{_ASSIGNED}|{_ADDRESS})", 0))
        return F.struct(
            F.substring(place["match"], ahead + 1, F.length(place["match"])).alias("value"),
            (place["start"] + ahead).alias("start"),
        )

    # Assigned values that are long runs of token characters are found as such.
    other = F.filter(F.transform(_places(text, ASSIGNED), behind), lambda p: ~F.regexp_like(p["value"], F.lit(f"^(?:{CANDIDATE})$")))
    none = F.array().cast("array<struct<value:string,start:int>>")
    places = F.concat(F.coalesce(long, none), F.coalesce(other, none))
    found = rows.select("row", "doc_id", "text", "digest", F.explode(places).alias("place"))
    return found.select("row", "doc_id", "text", "digest", "place.*").select(
        "row",
        "doc_id",
        "value",
        "start",
        F.substring(text, F.greatest(F.lit(1), F.col("start") - BEFORE), F.least(F.lit(BEFORE), F.col("start") - 1)).alias("before"),
        F.substring(text, F.col("start") + F.length("value"), F.lit(AFTER)).alias("after"),
        "digest",
    )


def dictionary(docs: DataFrame, text_col: str = "text", fewest: int = FEWEST_DOCUMENTS) -> DataFrame:
    """The words of the corpus that enough documents have, by a count over all of them."""
    words = F.regexp_extract_all(F.lower(F.col(text_col).cast("string")), F.lit("[a-z]{3,24}"), F.lit(0))
    return (
        docs.select(F.explode(F.array_distinct(words)).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= fewest)
        .select("word")
    )


def _share(pattern: str) -> Column:
    return F.regexp_count(F.col("value"), F.lit(pattern)) / F.length("value")


def _holds(column: str, pattern: str) -> Column:
    return F.regexp_like(F.col(column), F.lit(pattern)).cast("int")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Findings with the columns of FEATURES. Values that occur often are looked up once."""
    runs = found.select("value").distinct().withColumn(
        "run", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,24}"), F.lit(0)))
    )
    covered = (
        runs.join(words, runs["run"] == words["word"])
        .groupBy("value")
        .agg(F.sum(F.length("run")).alias("letters"))
    )
    turn = "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[+/_=-])(?=[^+/_=-])"
    return found.join(covered, "value", "left").select(
        *found.columns,
        F.length("value").cast("double").alias("length"),
        _share("[0-9]").alias("digits"),
        _share("[A-Z]").alias("capitals"),
        _share(turn).alias("turns"),
        _share("(?i)[aeiouy](?=[bcdfghjklmnpqrstvwxz])").alias("syllables"),
        (F.size(F.array_distinct(F.split("value", ""))) / F.length("value")).alias("variety"),
        (F.coalesce("letters", F.lit(0)) / F.length("value")).alias("covered"),
        F.greatest(_holds("value", "/"), _holds("before", r"[/\\.]$"), _holds("after", r"^[/\\.]\w")).alias("path"),
        _holds("before", KEYWORD).alias("keyword"),
        _holds("before", r"""[=:]\s*["']?$""").alias("assigned"),
        _holds("after", r"""^["']""").alias("quoted"),
        F.greatest(*[_holds(c, "(?i)example|sample|dummy|placeholder") for c in ("before", "after")]).alias("example"),
    )


def format_label() -> Column:
    """1 for findings of a known format or assigned to a keyword, else 0: labels for want of better."""
    assigned = (F.col("keyword") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0)
    return (F.regexp_like(F.col("value"), F.lit(KNOWN_FORMAT)) | assigned).cast("double")


def train(labelled: DataFrame, label_col: str = "label", sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH) -> Model | None:
    """A forest from findings with features and labels, at most `sample` distinct values of them,
    half of each class where there are enough, weighted to the mix of all; None without both classes."""
    draw = F.xxhash64("value", F.lit(5))
    # Of the places of a value, one with the highest label.
    best = F.max(F.struct(label_col, *FEATURES)).alias("best")
    rows = labelled.where(F.col(label_col).isin(0, 1)).groupBy("value").agg(best).select("value", "best.*")
    halves = [rows.where(F.col(label_col) == k).orderBy(draw, "value").limit(sample // 2) for k in (0, 1)]
    weight = class_weight(rows, label_col, sample)
    chosen = store(
        halves[0]
        .unionByName(halves[1])
        .select(*FEATURES, F.col(label_col).cast("double").alias("label"), weight.alias("weight")),
        "labelled",
    )
    if chosen.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight",
        numTrees=trees, maxDepth=depth, seed=3, featureSubsetStrategy="sqrt",
    )
    # The copy lacks the training summary, which holds the session and cannot go to executors.
    return forest.fit(_assembled(chosen)).copy()


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def judge(rows: DataFrame, model: Model | None, label_col: str = "label") -> DataFrame:
    """Findings with the forest's probability; without a forest it is the label itself."""
    if model is None:
        return rows.withColumn("probability", F.col(label_col).cast("double"))
    kept = [c for c in rows.columns if c not in ("features", "rawPrediction", "probability", "prediction")]
    scored = model.copy().transform(_assembled(rows.select(*kept)))
    return scored.select(*kept, vector_to_array("probability")[1].alias("probability"))


def scan(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    sample: int = SAMPLE,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The secrets: row, doc_id, value, start, before, after, probability: every place of values of which
    one place in the document has at least `threshold`. `digest` is the SHA-256 of the document's text, by
    which redact() finds it.

    `labelled` has findings with features and a label, for instance with_features() of reviewed
    ones; without it, the findings at hand are labelled by their format. Findings are stored
    before anything reads them, so texts are scanned once for candidates and once for the dictionary.
    Repeated rows repeat their findings; empty tables give none.
    """
    found = with_features(store(findings(docs, id_col, text_col), "candidates"), dictionary(docs, text_col))
    rows = store(found.withColumn("label", format_label()), "findings")
    model = train(rows if labelled is None else labelled, sample=sample)
    judged = judge(rows, model).select("row", "doc_id", "value", "start", "before", "after", "probability", "digest")
    sure = judged.where(F.col("probability") >= threshold).select("row", "value").distinct()
    return judged.join(sure, ["row", "value"], "left_semi").select(judged.columns)


def redact(docs: DataFrame, secrets: DataFrame, mark: str = "[secret]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every place of their secrets replaced; all columns are kept.

    Longer values are replaced first, so a value within another one leaves no rest. The list of a
    document's secrets is bounded by its text. Secrets with a `digest`, as scan() gives them, are found by the
    text itself, so rows without an id and rows that share one are redacted too. Secrets that name
    only a doc_id go by that, and rows without an id are then left as they are.
    """
    by_text = "digest" in secrets.columns
    name = "digest" if by_text else "doc_id"
    lists = (
        secrets.where(F.col(name).isNotNull())
        .groupBy(F.col(name).alias("_id"))
        .agg(F.collect_set(F.struct((-F.length("value")).alias("order"), "value")).alias("_secrets"))
    )
    own = lists["_secrets"]
    new_text = F.aggregate(
        F.sort_array(own), docs[text_col], lambda text, s: F.replace(text, s["value"], F.lit(mark))
    )
    text = F.when(own.isNull(), docs[text_col]).otherwise(new_text)
    place = F.sha2(docs[text_col].cast("string"), 256) if by_text else docs[id_col].cast("long")
    joined = docs.join(lists, place == lists["_id"], "left")
    return joined.select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns])
