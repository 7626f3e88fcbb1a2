"""Checks of JSON messages as they were sent, unknown keys and wrong types included.

Parsing into declared columns drops every key that is not declared and turns "1.5" into a number.
Here a message is parsed once, into a variant, whose keys and types are looked at before any
column is made of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.quality import ENVELOPE_TYPE
from tickloom.schema import ENVELOPE

# The declared keys of envelopes and trades, and what the trades' keys stand for.
ENVELOPE_KEYS = ("type", "data")
TRADE_KEYS = {"p": "price", "s": "symbol", "t": "time", "v": "volume", "c": "conditions"}

_NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$"
_MESSAGE = "_message"


def _kind(value: Column, path: str = "$") -> Column:
    """The type of a part of a variant; NULL if it is absent."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def _keys(value: Column) -> Column:
    return F.coalesce(F.map_keys(F.try_variant_get(value, "$", "map<string,variant>")), F.array().cast("array<string>"))


def _unknown(keys: Column, known: tuple[str, ...], of: str) -> Column:
    extra = F.array_sort(F.array_distinct(F.array_except(keys, F.array(*[F.lit(k) for k in known]))))
    return F.transform(extra, lambda key: F.concat(F.lit(f"{of} key "), key, F.lit(" unknown")))


def _listed(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))


def _problems(message: Column, symbol_pattern: str | None) -> Column:
    items = F.coalesce(F.try_variant_get(message, "$.data", "array<variant>"), F.array().cast("array<variant>"))

    def any_item(broken) -> Column:
        return F.exists(items, lambda item: F.coalesce(broken(item), F.lit(False)))

    def absent(key: str) -> Column:
        return any_item(lambda item: _kind(item).startswith("OBJECT") & _kind(item, f"$.{key}").isNull())

    def not_like(key: str, pattern: str) -> Column:
        return any_item(lambda item: ~F.regexp_like(_kind(item, f"$.{key}"), F.lit(pattern)))

    def number(item: Column, key: str) -> Column:
        return F.when(F.regexp_like(_kind(item, f"$.{key}"), F.lit(_NUMBER)), F.try_variant_get(item, f"$.{key}", "double"))

    kind, data = _kind(message, "$.type"), _kind(message, "$.data")
    rules = {
        "type missing": kind.isNull(),
        "type malformed": kind != "STRING",
        "type unknown": (kind == "STRING") & (F.try_variant_get(message, "$.type", "string") != ENVELOPE_TYPE),
        "data missing": data.isNull(),
        "data malformed": ~data.startswith("ARRAY"),
        "trade malformed": F.exists(items, lambda item: ~F.coalesce(_kind(item).startswith("OBJECT"), F.lit(False))),
        **{f"{TRADE_KEYS[key]} missing": absent(key) for key in ("p", "s", "t", "v")},
        "price malformed": not_like("p", _NUMBER),
        "symbol malformed": not_like("s", "^STRING$"),
        # 1.0 is a whole number, 1.5 is none.
        "time malformed": not_like("t", _NUMBER) | any_item(lambda item: number(item, "t") != F.floor(number(item, "t"))),
        "volume malformed": not_like("v", _NUMBER),
        "conditions malformed": not_like("c", r"^(VOID|ARRAY<(STRING|VOID)>)$")
        | any_item(lambda item: F.exists(F.try_variant_get(item, "$.c", "array<variant>"), lambda c: F.coalesce(F.schema_of_variant(c) != "STRING", F.lit(True)))),
        "time negative": any_item(lambda item: number(item, "t") < 0),
        "volume negative": any_item(lambda item: number(item, "v") < 0),
    }
    if symbol_pattern is not None:
        text = any_item(lambda item: ~F.regexp_like(F.try_variant_get(item, "$.s", "string"), F.lit(symbol_pattern)))
        rules["symbol malformed"] = rules["symbol malformed"] | text
    trade_keys = F.flatten(F.transform(items, _keys))
    return F.concat(
        _listed(rules),
        _unknown(_keys(message), ENVELOPE_KEYS, "envelope"),
        _unknown(trade_keys, tuple(TRADE_KEYS), "trade"),
    )


def check_messages(messages: DataFrame, value: str = "value", symbol_pattern: str | None = None) -> DataFrame:
    """Add the envelope's columns and `problems` to JSON messages, on a table or on a stream.

    The rules are those of check_envelopes(), and: no keys but the declared ones, in envelopes and in
    trades; values of the declared JSON types. One bad trade makes its whole message bad. A
    message that is missing, blank, not JSON (an object with a key twice is none) or no object has that problem only. The
    envelope's columns are NULL in bad messages. Columns of the same names are replaced. Each
    message is parsed once; there is no shuffle.
    """
    kept = [c for c in messages.columns if c not in (*ENVELOPE.names, "problems")]
    text = messages[value].cast("string")
    # Unpacked from a one-element array, the parsed message is not computed again by those who read it.
    parsed = messages.select(
        *[messages[c] for c in kept],
        *([] if value in kept else [messages[value].alias("_text")]),
        F.inline(F.array(F.struct(F.try_parse_json(text).alias(_MESSAGE)))),
    )
    message, text = F.col(_MESSAGE), F.col(value if value in kept else "_text").cast("string")
    whole = (
        F.when(text.isNull(), "message missing")
        .when(F.trim(text) == "", "message blank")
        .when(message.isNull(), "message malformed")
        .when(~_kind(message).startswith("OBJECT"), "message no object")
    )
    problems = F.when(whole.isNotNull(), F.array(whole)).otherwise(_problems(message, symbol_pattern))
    checked = parsed.select("*", F.inline(F.array(F.struct(problems.alias("problems")))))
    good = F.size("problems") == 0

    def column(name: str) -> Column:
        kind = ENVELOPE[name].dataType
        return F.when(good, F.try_variant_get(message, f"$.{name}", kind.simpleString())).cast(kind).alias(name)

    return checked.select(*kept, *[column(name) for name in ENVELOPE.names], "problems")


def accept_messages(
    messages: DataFrame, value: str = "value", symbol_pattern: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(envelopes of the good messages, the other messages with `problems`). The two frames are two
    reads of the messages: in a batch function, pass a cached batch."""
    checked = check_messages(messages, value, symbol_pattern)
    good = F.size("problems") == 0
    return checked.where(good).select(*ENVELOPE.names), checked.where(~good).drop(*ENVELOPE.names)
