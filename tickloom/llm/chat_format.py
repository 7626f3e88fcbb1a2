"""Chat formatting by schema fingerprints (operator 12).

A record, JSON text or a variant, is told by its layout: the nested field paths that it has are
listed, those that some layout knows are sorted and hashed, and the hash selects a declarative mapping that
says where the turns are. Fields that no layout knows do not matter; records whose hash no layout
has are left without turns.

Canonical turns (role, text) are then written by a template that marks each one:

    <|im_start|>ROLE newline TEXT<|im_end|> newline

In roles and texts a backslash goes into every `<`, backslashes, `|`, so that no control string can
occur in them, and is taken out on reading; line feeds in roles are written as a backslash and n. The
loss mask is a list of runs, one (before, trained, after) per turn in characters (code points), which
together cover the string: only texts of the assistant are trained on.

All of this is built-in functions on DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from hashlib import sha256
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
TURNS = "array<struct<role: string, text: string>>"
COLUMNS = ("layout", "fingerprint", "turns", "formatted", "loss_mask")


@dataclass(frozen=True)
class Flat:
    """Fields of the record are turns: (role, fields), whose texts are joined by an empty line.

    `optional` fields may be absent; turns without any of their fields, or with empty ones only, are left
    out unless a field of theirs is required.
    """

    name: str
    parts: tuple[tuple[str, tuple[str, ...]], ...]
    optional: tuple[str, ...] = ()

    def path_sets(self) -> list[tuple[str, ...]]:
        fields = [f for _, own in self.parts for f in own]
        required = [f for f in fields if f not in self.optional]
        return [(*required, *some) for n in range(len(self.optional) + 1) for some in combinations(self.optional, n)]

    def turns(self, record: Column) -> Column:
        made = []
        for role, fields in self.parts:
            texts = [_text(record, f"$.{f}") for f in fields]
            filled = F.filter(F.array(*texts), lambda t: F.length(t) > 0)
            required = any(f not in self.optional for f in fields)
            turn = F.struct(F.lit(role).alias("role"), F.array_join(filled, "\n\n").alias("text"))
            made.append(turn if required else F.when(F.size(filled) > 0, turn))
        return F.array_compact(F.array(*made))


@dataclass(frozen=True)
class Listed:
    """A list of objects, one per turn. `aliases` are (role there, role here), in lower case."""

    name: str
    container: str
    role: str
    text: str
    aliases: tuple[tuple[str, str], ...] = ()

    def path_sets(self) -> list[tuple[str, ...]]:
        at = f"{self.container}[]"
        # An empty list has no fields. A text may be a list of parts, with or without their kinds.
        texts = [(f"{at}.{self.text}",), (f"{at}.{self.text}[].text",), (f"{at}.{self.text}[].text", f"{at}.{self.text}[].type")]
        return [(f"{at}:VOID",), *[(f"{at}.{self.role}", *t) for t in texts]]

    def turns(self, record: Column) -> Column:
        items = F.try_variant_get(record, "$" + (f".{self.container}" if self.container else ""), "array<variant>")
        known = F.create_map(*[F.lit(x) for pair in self.aliases for x in pair]) if self.aliases else None

        def turn(item: Column) -> Column:
            role = F.coalesce(F.try_variant_get(item, f"$.{self.role}", "string"), F.lit(""))
            if known is not None:
                role = F.coalesce(F.try_element_at(known, F.lower(role)), role)
            return F.struct(role.alias("role"), _text(item, f"$.{self.text}").alias("text"))

        return F.transform(items, turn)


@dataclass(frozen=True)
class Alternating:
    """A list of texts, of the user and the assistant in turn."""

    name: str
    container: str

    def path_sets(self) -> list[tuple[str, ...]]:
        return [(f"{self.container}[]",), (f"{self.container}[]:VOID",)]

    def turns(self, record: Column) -> Column:
        def turn(text: Column, i: Column) -> Column:
            role = F.when(i % 2 == 0, "user").otherwise(TRAINED_ROLE)
            return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))

        return F.transform(F.try_variant_get(record, f"$.{self.container}", "array<string>"), turn)


Layout = Flat | Listed | Alternating

_ROLES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"), ("chatgpt", "assistant"))

LAYOUTS: tuple[Layout, ...] = (
    Flat("prompt and completion", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), ("system",)),
    Flat("prompt and response", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), ("system",)),
    Flat("question and answer", (("user", ("context", "question")), ("assistant", ("answer",))), ("context",)),
    Flat(
        "instruction",
        (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
        ("system", "input"),
    ),
    Listed("messages", "messages", "role", "content"),
    Listed("list of messages", "", "role", "content"),
    Listed("conversations", "conversations", "from", "value", _ROLES),
    Listed("turns", "turns", "role", "text"),
    Alternating("dialogue", "dialogue"),
)


def _text(value: Column, path: str) -> Column:
    """A text, or the joined texts of a list of parts; empty for NULL."""
    parts = F.try_variant_get(value, path, "array<struct<text: string>>")
    joined = F.array_join(F.transform(parts, lambda p: p["text"]), "")
    return F.coalesce(joined, F.try_variant_get(value, path, "string"), F.lit(""))


def fingerprint_of(paths: Iterable[str]) -> str:
    return sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def field_paths(record: Column, known: Sequence[str]) -> Column:
    """The paths of `known` that a variant has, sorted: a.b for fields, a[] for elements, a[]:VOID for
    lists without any. The variant's schema is read token by token; its other fields take no space."""
    # Names end with a colon and a blank; all else is brackets and types.
    pattern = r"`(?:[^`]|``)*`: |\w+: |(?:OBJECT|ARRAY)<|>|[A-Z]+(?:\(\d+,\d+\))?"
    tokens = F.regexp_extract_all(F.schema_of_variant(record), F.lit(pattern), F.lit(0))
    none = F.array().cast("array<string>")
    start = F.struct(F.array(F.lit("")).alias("stack"), F.lit("").alias("at"), none.alias("found"))

    def step(state: Column, token: Column) -> Column:
        stack, at, found = state["stack"], state["at"], state["found"]
        named, closes = token.endswith(": "), token == ">"
        element, top = F.concat(at, F.lit("[]")), F.element_at(stack, -1)
        name = F.substring(token, F.lit(1), F.length(token) - 2)
        # A name that looks like a path is none.
        plain = F.when(F.regexp_like(name, F.lit(r"[.:\[\]]")), "?").otherwise(F.replace(name, F.lit("`"), F.lit("")))
        inside = F.when(top == "", plain).otherwise(F.concat(top, F.lit("."), plain))
        opens = F.when(token == "OBJECT<", at).when(token == "ARRAY<", element)
        path = F.when((token == "VOID") & at.endswith("[]"), F.concat(at, F.lit(":VOID"))).otherwise(at)
        leaf = ~named & ~closes & opens.isNull() & path.isin(*known)
        return F.struct(
            F.when(opens.isNotNull(), F.concat(stack, F.array(opens)))
            .when(closes, F.slice(stack, F.lit(1), F.size(stack) - 1))
            .otherwise(stack)
            .alias("stack"),
            F.when(named, inside).otherwise(F.coalesce(opens, at)).alias("at"),
            F.when(leaf, F.concat(found, F.array(path))).otherwise(found).alias("found"),
        )

    return F.array_sort(F.array_distinct(F.aggregate(tokens, start, step, lambda s: s["found"])))


def with_turns(records: DataFrame, record_col: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Add layout (a name), fingerprint (hex) and turns, for JSON texts or variants in `record_col`.

    All three are NULL for NULL records and texts that are not JSON; layout and turns are NULL where no
    layout has the fingerprint. A NULL text or role becomes an empty one. Columns that are already called so
    are replaced. One pass, no shuffle.
    """
    owners: dict[str, str] = {}
    for layout in layouts:
        for paths in layout.path_sets():
            if owners.setdefault(fingerprint_of(paths), layout.name) != layout.name:
                raise ValueError(f"{owners[fingerprint_of(paths)]} and {layout.name} have the same paths")
    known = sorted({path for layout in layouts for paths in layout.path_sets() for path in paths})
    kept = [c for c in records.columns if c not in COLUMNS[:3]]
    given = records[record_col]
    if not isinstance(records.schema[record_col].dataType, T.VariantType):
        given = F.try_parse_json(given.cast("string"))
    own = "_record"
    while own in kept:
        own += "_"
    rows = records.select(*[records[c] for c in kept], given.alias(own))
    record = F.col(own)
    hashed = F.when(record.isNotNull(), F.sha2(F.array_join(field_paths(record, known), "\n"), 256))
    named = rows.withColumn("fingerprint", hashed)
    owner = F.create_map(*[F.lit(x) for pair in owners.items() for x in pair])
    named = named.withColumn("layout", F.try_element_at(owner, F.col("fingerprint")))
    turns = F.lit(None).cast(TURNS)
    for layout in layouts:
        turns = F.when(F.col("layout") == layout.name, layout.turns(record).cast(TURNS)).otherwise(turns)
    return named.select(*kept, "layout", "fingerprint", turns.alias("turns"))


def escaped(text: Column) -> Column:
    """A text without control strings, from which unescaped() gives the text back."""
    return F.when(text.contains("<"), F.regexp_replace(text, r"(?<=<)(?=\\*\|)", r"\\")).otherwise(text)


def unescaped(text: Column) -> Column:
    return F.when(text.contains("<"), F.regexp_replace(text, r"(?<=<)\\(?=\\*\|)", "")).otherwise(text)


def escaped_role(role: Column) -> Column:
    """As escaped(), without line feeds: backslashes are doubled, and a single one and n stand for a line feed."""
    doubled = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    return escaped(F.replace(doubled, F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    fed = F.regexp_replace(unescaped(role), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(fed, F.lit("\\\\"), F.lit("\\"))


def formatted(turns: Column) -> Column:
    """The string of all turns."""
    return F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n"), escaped(t["text"]), F.lit(f"{END}\n")),
        ),
        "",
    )


def loss_mask(turns: Column, trained_role: str = TRAINED_ROLE) -> Column:
    """Per turn the characters before, in and after its trained text."""

    def run(turn: Column) -> Column:
        head = F.length(escaped_role(turn["role"])) + len(START) + 1
        body = F.length(escaped(turn["text"]))
        trained = turn["role"] == trained_role
        return F.struct(
            head.alias("before"),
            F.when(trained, body).otherwise(0).alias("trained"),
            (F.when(trained, 0).otherwise(body) + len(END) + 1).alias("after"),
        )

    return F.transform(turns, run)


def format_records(records: DataFrame, record_col: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """with_turns(), and formatted and loss_mask, which are NULL where the turns are."""
    rows = with_turns(records, record_col, layouts)
    return rows.withColumn("formatted", formatted(F.col("turns"))).withColumn("loss_mask", loss_mask(F.col("turns")))


def _written(text: Column) -> Column:
    """The turns of a formatted string, each without its start."""
    pieces = F.split(text, r"<\|im_start\|>", -1)
    return F.slice(pieces, F.lit(2), F.size(pieces) - 1)


def read_turns(text: Column) -> Column:
    """The turns back from a formatted string."""

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        head = F.length(role) + 1
        body = F.substring(piece, head + 1, F.length(piece) - head - len(END) - 1)
        return F.struct(unescaped_role(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(_written(text), turn)


def read_trained(text: Column, mask: Column) -> Column:
    """The texts under the loss mask, unescaped, as one string. Runs and turns go together, so the
    string is cut into turns first and no run is looked for from the string's start."""
    texts = F.zip_with(
        _written(text),
        mask,
        lambda piece, run: F.when(run["trained"] > 0, unescaped(F.substring(piece, run["before"] + 1 - len(START), run["trained"]))),
    )
    return F.array_join(texts, "")


def conversation_records(rows: DataFrame) -> DataFrame:
    """conv_id and record, a variant {"turns": [{"role", "text"}]}, from rows of turns.

    Rows of a conversation are in order of turn, NULL first; rows of the same turn in order of role
    and text. NULL texts and roles are empty. Rows without a conv_id are one conversation. A
    conversation is one row, and must fit a task.
    """
    filled = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    grouped = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(filled)).alias("turns"))
    own = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return grouped.select("conv_id", F.to_variant_object(F.struct(own.alias("turns"))).alias("record"))


def conversation_digests(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars: what is read back from
    the formatted conversations."""
    made = format_records(conversation_records(rows), "record").select("conv_id", "formatted", "loss_mask")
    read = made.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        read_trained(F.col("formatted"), F.col("loss_mask")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
