"""DuckDB SQL for the corpus queries that SQL can express on whole tables; the others are
tested against brute force."""

from __future__ import annotations

_LEVELS = 6  # of a tree, in the SQL: 16**6 leaves
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _crc32(text: str) -> str:
    byte = "lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END"
    step = f"lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), {byte})"
    bytes_of = f"list_transform(string_split({text}, ''), lambda x: ord(x)::UBIGINT)"
    return f"xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, {bytes_of}), {step}))"


def _tree(name: str, start: str, key: str) -> list[str]:
    """Levels name0 ... of the trees of (key, i, d, size), and their runs of siblings."""
    out = [f"{name}0 AS ({start})"]
    for k in range(_LEVELS):
        out.append(
            f"{name}run{k} AS (SELECT {key}, i // 16 AS up, size, list(d ORDER BY i) AS run"
            f" FROM {name}{k} WHERE size > 1 GROUP BY ALL)"
        )
        out.append(
            f"{name}{k + 1} AS (SELECT {key}, up AS i, sha256(array_to_string(run, '')) AS d,"
            f" (size + 15) // 16 AS size FROM {name}run{k})"
        )
    return out


def _fold(name: str, base: str, runs: str, key: str, i: str) -> list[str]:
    """Relations name0 ... that carry each row of `base` up through the runs: `proof` and `folded` grow."""
    out, before = [], base
    for k in range(_LEVELS):
        at = f"b.{i} // {16**k} % 16"
        left, right = f"array_to_string(run[1:{at}], '')", f"array_to_string(run[{at} + 2:], '')"
        out.append(
            f"{name}{k} AS (SELECT b.* REPLACE (CASE WHEN run IS NULL THEN proof ELSE proof || {left} || {right} END AS proof,"
            f" CASE WHEN run IS NULL THEN folded ELSE sha256({left} || folded || {right}) END AS folded)"
            f" FROM {before} b LEFT JOIN {runs}{k} r ON r.{key} = b.{key} AND r.up = b.{i} // {16 ** (k + 1)})"
        )
        before = f"{name}{k}"
    return out


def _merkle() -> str:
    own = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text")))
    changed = " || ".join([*map(_field, ("doc_id", "source", "lang", "n_chars")), _field(_lower("text"))])
    tops = " UNION ALL ".join(f"SELECT key, d FROM t{k} WHERE size = 1" for k in range(_LEVELS + 1))
    root = " UNION ALL ".join(f"SELECT d FROM s{k} WHERE size = 1" for k in range(_LEVELS + 1))
    parts = [
        f"""digests AS (SELECT doc_id, coalesce('=' || source, '-') AS key, sha256({own}) AS leaf,
            CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN sha256({changed}) ELSE sha256({own}) END AS other FROM documents)""",
        """leaves AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
            count(*) OVER (PARTITION BY key) AS size FROM digests)""",
        *_tree("t", "SELECT key, i, leaf AS d, size FROM leaves", "key"),
        f"subroots AS (SELECT *, row_number() OVER (ORDER BY key) - 1 AS j, count(*) OVER () AS n FROM ({tops}))",
        *_tree("s", "SELECT 0 AS one, j AS i, d, n AS size FROM subroots", "one"),
        f"root AS ({root})",
        """start AS (SELECT doc_id, l.key, 0 AS one, i, j, leaf, d AS subroot, '' AS proof, other AS folded
            FROM leaves l JOIN subroots USING (key))""",
        *_fold("f", "start", "trun", "key", "i"),
        *_fold("g", f"f{_LEVELS - 1}", "srun", "one", "j"),
    ]
    return f"""WITH {", ".join(parts)}
        SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = d AS verified
        FROM g{_LEVELS - 1}, root"""


def _phrases() -> str:
    ends = r"[.,;:!?\x0A-\x0D]"
    words = ", ".join(f"lead(w, {k}) OVER o AS w{k}, lead(p, {k}) OVER o AS p{k}" for k in (1, 2))
    return rf"""WITH pieces AS (SELECT doc, lang, unnest(list_zip(piece, range(len(piece)))) AS z FROM (
            SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
                regexp_split_to_array({_lower("coalesce(text, '')")}, '{ends}') AS piece FROM documents)),
        split AS (SELECT doc, lang, z[2] AS p, regexp_extract_all(z[1], '[^\x20\x09]+') AS w FROM pieces),
        tokens AS (SELECT doc, lang, p, unnest(list_zip(w, range(len(w)))) AS z FROM split),
        flat AS (SELECT doc, lang, p, z[1] AS w, z[2] AS i FROM tokens),
        near AS MATERIALIZED (SELECT lang, w, p, {words} FROM flat WINDOW o AS (PARTITION BY doc ORDER BY p, i)),
        f AS MATERIALIZED (SELECT lang, 1 AS m, w AS phrase, count(*) AS f FROM near GROUP BY ALL
            UNION ALL SELECT lang, 2, w || ' ' || w1, count(*) FROM near WHERE p1 = p GROUP BY ALL
            UNION ALL SELECT lang, 3, w || ' ' || w1 || ' ' || w2, count(*) FROM near WHERE p2 = p GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
        candidates AS MATERIALIZED (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 10),
        halves AS MATERIALIZED (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
            FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)),
        frequent AS MATERIALIZED (SELECT lang, phrase, f FROM f WHERE f >= 10),
        cuts AS (SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, (1000000 * a::HUGEINT * a // (l.f::HUGEINT * r.f))::BIGINT AS score
            FROM halves c JOIN frequent l ON l.lang = c.lang AND l.phrase = head JOIN frequent r ON r.lang = c.lang AND r.phrase = tail),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inside AS (SELECT lang, phrase, max(a) AS f FROM (SELECT lang, a,
            unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidates WHERE m = 3) GROUP BY ALL),
        kept AS (SELECT b.* FROM best b LEFT JOIN inside o ON o.lang = b.lang AND o.phrase = b.phrase
            WHERE o.f IS NULL OR 100 * o.f < 50 * b.a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER
            (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN totals USING (lang) WHERE rank <= 2000"""


def _chats() -> str:
    said = "<|im_end|><|im_start|>assistant ok"
    ordered = "ORDER BY turn NULLS FIRST, role, text"
    # Every < that backslashes and a bar follow gets one more backslash; roles of the tables have neither.
    escaped = r"length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))"
    return f"""WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{said}' UNION ALL SELECT -1, 1, 'assistant', '{said}'),
        made AS (SELECT conv_id, count(*) AS n_turns,
            string_agg(role || chr(10) || text || chr(10), '' {ordered}) AS turns,
            coalesce(string_agg(text, '' {ordered}) FILTER (role = 'assistant'), '') AS loss,
            sum(length('<|im_start|>') + length(role) + 1 + {escaped} + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
            FROM rows GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
            formatted_chars FROM made"""


def oracle_sql() -> dict[str, str]:
    return {"op11_phrases": _phrases(), "op12_chat_format": _chats(), "op13_merkle_manifest": _merkle()}
