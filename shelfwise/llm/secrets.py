"""Secrets in texts: fixed patterns, and strings whose characters look random.

Patterns: an assignment to a secret's name, an access key, a long run of hex
digits.  What they take, and known harmless values, is moved out of the way:
its characters become private ones, one for one, so that offsets stay.  The
runs of 20 or more key characters that are left are candidates.  A window of 20
characters slides over each; its Shannon entropy follows from the counts of its
characters, which each step changes by one character in and one out.  Windows
over the threshold of the candidate's character class (hex, one case, base 64)
join to spans.  Runs without digits or without letters are left out.

Everything is built from SQL functions, in time that grows with the text: long
candidates are cut into segments that overlap by a window, and offsets of many
matches come from sums over blocks of matches.  c * log2(c) is a table of whole
millionths, so sums stay exact however they are formed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import read
from shelfwise.llm.registry import query

# Patterns of the kinds, with the lengths they must reach.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # 20 characters and more
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "entropy")
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=-"
# Printable ASCII and the private characters that stand for it where a pattern has taken it; others of theirs give way.
PLAIN = "".join(map(chr, range(0x20, 0x7F)))
TAKEN = "".join(chr(0xE000 + ord(c)) for c in PLAIN)
OTHER = "\uf8ff"


def _either(chars: str) -> str:
    """A class of the characters, plain or taken; ranges as in a pattern."""
    return f"[{chars}{''.join(c if c == '-' else chr(0xE000 + ord(c)) for c in chars)}]"


# The patterns over texts of which an earlier pattern has taken parts.
ACCESS_EITHER = "".join(map(_either, "AKIA")) + _either("A-Z") .replace("]", _either("0-9")[1:]) + "{16,}"
HEX_EITHER = _either("0-9").replace("]", _either("a-f")[1:]) + "{24,}"
# Digests of empty input and placeholder sequences.
ALLOWED = (
    "d41d8cd98f00b204e9800998ecf8427e",
    "da39a3ee5e6b4b0d3255bfef95601890afd80709",
    "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
    "0123456789abcdef",
    "abcdefghijklmnopqrstuvwxyz",
    "00000000-0000-0000-0000-000000000000",
)

ALLOW = "(?i)" + "|".join(ALLOWED)

WINDOW = 20
#: Bits of entropy a window needs, by class; and the digits a one-case run must have.
HEX_BITS, ONE_CASE_BITS, BASE64_BITS = 3.0, 3.75, 3.7
ONE_CASE_DIGITS = 3
#: Matches of a block, and windows of a segment.
BLOCK, SEGMENT = 256, 256
MILLION = 1_000_000
#: c * log2(c) for c = 0 ... WINDOW, in millionths.
TERMS = [0, 0] + [round(c * math.log2(c) * MILLION) for c in range(2, WINDOW + 1)]


def most_sum(bits: float) -> int:
    """A window has at least ``bits`` of entropy if its terms sum to no more."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * MILLION)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def matches(text: Column, pattern: str) -> Column:
    """(start, end, value) of all leftmost matches; offsets in code points, end exclusive.

    The text between matches comes from a split by the same pattern.  Offsets
    are sums over earlier blocks and within a block, so their cost does not
    grow with the square of the matches.
    """
    kind = "array<struct<start:int,end:int,value:string>>"
    parts = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda before, value: F.struct(
            F.char_length(before).alias("before"), F.coalesce(F.char_length(value), F.lit(0)).alias("size"), value.alias("value")
        ),
    )

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["before"]
        end = start + part["size"]
        one = F.array(F.struct(start.alias("start"), end.alias("end"), part["value"].alias("value")))
        found = F.when(part["value"].isNull(), state["found"]).otherwise(F.concat(state["found"], one))
        return F.struct(end.alias("at"), found.alias("found"))

    def of_block(block: Column, base: Column) -> Column:
        begin = F.struct(base.alias("at"), F.array().cast(kind).alias("found"))
        return F.aggregate(block, begin, step, lambda state: state["found"])

    def of_blocks(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, part: n + part["before"] + part["size"]))
        bases = let(
            sizes,
            lambda z: F.transform(z, lambda _, i: F.aggregate(F.slice(z, F.lit(1), i), F.lit(0), lambda n, size: n + size)),
        )
        return F.flatten(F.zip_with(blocks, bases, of_block))

    def blocked(all_parts: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_parts) - 1) / BLOCK).cast("int")),
            lambda i: F.slice(all_parts, i * BLOCK + 1, F.lit(BLOCK)),
        )

    found = let(let(parts, blocked), of_blocks)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(kind))


def taken(text: Column, pattern: str, keep=None) -> Column:
    """``text`` with the matches of a pattern, or those for which ``keep`` holds, in private characters."""
    moved = lambda value: F.translate(value, PLAIN, TAKEN)
    change = moved if keep is None else (lambda value: F.when(keep(value), moved(value)).otherwise(value))
    parts = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda before, value: F.concat(before, F.coalesce(change(value), F.lit(""))),
    )
    return F.when(text.rlike(pattern), F.array_join(parts, "")).otherwise(text)


def long_enough(value: Column) -> Column:
    """Whether an assignment's value has the characters it needs."""
    return F.char_length(F.regexp_extract(value, ASSIGN, 2)) >= ASSIGN_VALUE


def left_over(text: Column) -> Column:
    """``text`` without what the patterns take and without allowed values, offsets kept."""
    fresh = F.when(text.rlike(f"[{TAKEN[0]}-{TAKEN[-1]}]"), F.translate(text, TAKEN, OTHER * len(TAKEN))).otherwise(text)
    steps = [
        lambda t: taken(t, ASSIGN, long_enough),
        lambda t: taken(t, ACCESS_EITHER),
        lambda t: taken(t, HEX_EITHER),
        lambda t: taken(t, ALLOW),
    ]
    out = fresh
    for step in steps:
        out = let(out, step)
    return out


_IS_HEX, _IS_ONE_CASE = "^[0-9A-Fa-f]+$", "^(?:[0-9a-z]+|[0-9A-Z]+)$"


def suspicious(value: Column) -> Column:
    """Candidates worth a look: digits among letters; hex, or one case with some digits, or both cases."""
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    one_case = value.rlike(_IS_ONE_CASE) & value.rlike("(?:[0-9][^0-9]*){%d}" % ONE_CASE_DIGITS)
    return mixed & (value.rlike(_IS_HEX) | one_case | (value.rlike("[a-z]") & value.rlike("[A-Z]")))


_RUNS = "array<struct<start:int,end:int>>"


def _segment_runs(letters: Column, first: Column, limit: Column) -> Column:
    """Joined windows of high entropy of a segment (its characters), offsets from ``first`` on.

    The counts of the window's characters are a text, a character per letter of
    the alphabet.
    """
    terms = F.array(*[F.lit(x).cast("long") for x in TERMS])
    place = lambda letter: F.instr(F.lit(ALPHABET), letter)
    steps = F.transform(
        letters,
        lambda letter, i: F.struct(
            i.alias("i"), place(letter).alias("new"), F.when(i >= WINDOW, place(F.get(letters, i - WINDOW))).alias("old")
        ),
    )
    count = lambda counts, at: F.ascii(F.substring(counts, at, F.lit(1))) - ord("A")
    put = lambda counts, at, n: F.overlay(counts, F.char(n + ord("A")), at, F.lit(1))

    def step(state: Column, x: Column) -> Column:
        def added(after: Column) -> Column:
            """``after``: counts and total once the old character has gone."""
            had = count(after["counts"], x["new"])
            total = after["total"] + F.get(terms, had + 1) - F.get(terms, had)
            return let(
                F.struct(put(after["counts"], x["new"], had + 1).alias("counts"), total.alias("total")),
                lambda now: F.struct(
                    now["counts"].alias("counts"),
                    now["total"].alias("total"),
                    F.when(
                        (x["i"] >= WINDOW - 1) & (now["total"] <= limit),
                        joined(state["runs"], first + x["i"] - (WINDOW - 1), first + x["i"] + 1),
                    )
                    .otherwise(state["runs"])
                    .alias("runs"),
                ),
            )

        gone = count(state["counts"], x["old"])
        less = F.struct(
            put(state["counts"], x["old"], gone - 1).alias("counts"),
            (state["total"] - F.get(terms, gone) + F.get(terms, gone - 1)).alias("total"),
        )
        same = F.struct(state["counts"].alias("counts"), state["total"].alias("total"))
        return let(F.when(x["old"].isNull(), same).otherwise(less), added)

    def joined(old: Column, start: Column, end: Column) -> Column:
        last = F.get(old, F.size(old) - 1)
        span = lambda s: F.array(F.struct(s.alias("start"), end.alias("end")))
        return F.when(last["end"] >= start, F.concat(F.slice(old, 1, F.size(old) - 1), span(last["start"]))).otherwise(
            F.concat(old, span(start))
        )

    begin = F.struct(
        F.lit("A" * len(ALPHABET)).alias("counts"), F.lit(0).cast("long").alias("total"), F.array().cast(_RUNS).alias("runs")
    )
    return F.aggregate(steps, begin, step, lambda state: state["runs"])


def random_parts(value: Column) -> Column:
    """(start, end) inside a candidate of the joined windows with high entropy."""
    bits = [(_IS_HEX, HEX_BITS), (_IS_ONE_CASE, ONE_CASE_BITS), (".", BASE64_BITS)]
    limit = F.coalesce(*[F.when(value.rlike(kind), F.lit(most_sum(b)).cast("long")) for kind, b in bits])

    def of_segments(x: Column) -> Column:
        return F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size(x["letters"]) - WINDOW) / SEGMENT).cast("int")),
                lambda k: let(
                    F.struct(F.slice(x["letters"], k * SEGMENT + 1, F.lit(SEGMENT + WINDOW - 1)).alias("own"), x["limit"].alias("limit")),
                    lambda y: _segment_runs(y["own"], k * SEGMENT, y["limit"]),
                ),
            )
        )

    def merged(runs: Column) -> Column:
        """Runs of neighbouring segments that touch become one: first starts beside last ends."""
        starts = F.filter(runs, lambda r, i: F.coalesce(F.get(runs, i - 1)["end"] < r["start"], F.lit(True)))
        ends = F.filter(runs, lambda r, i: F.coalesce(F.get(runs, i + 1)["start"] > r["end"], F.lit(True)))
        return F.zip_with(starts, ends, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))

    letters = F.struct(F.split(value, "").alias("letters"), limit.alias("limit"))
    return let(let(letters, of_segments), merged)


def secret_spans(text: Column) -> Column:
    """All spans as (start, kind, end), sorted; kind is the place in KINDS.

    Null is an empty text and has none.
    """
    text = F.coalesce(text, F.lit(""))

    def of(kind: int, found: Column) -> Column:
        return F.transform(
            found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
        )

    assign = F.filter(matches(text, ASSIGN), lambda m: long_enough(m["value"]))
    base = F.concat(of(0, assign), of(1, matches(text, ACCESS)), of(2, matches(text, HEX)))

    def added(left: Column) -> Column:
        candidates = F.filter(matches(left, CANDIDATE), lambda m: suspicious(m["value"]))
        return F.flatten(
            F.transform(
                candidates,
                lambda m: F.transform(
                    random_parts(m["value"]),
                    lambda r: F.struct(
                        (m["start"] + r["start"]).alias("start"), F.lit(3).alias("kind"), (m["start"] + r["end"]).alias("end")
                    ),
                ),
            )
        )

    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    more = F.when(text.rlike(CANDIDATE), let(left_over(text), added)).otherwise(none)
    return F.array_sort(F.concat(base, more))


def scan(df: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``df`` with its secrets as an array of (start, kind, end) under ``out``.

    ``out`` takes the place of an input column of that name; repeated rows
    repeat their result, an empty table gives none.
    """
    return df.withColumn(out, secret_spans(F.col(text_col)))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def _sql_taken(text: str, pattern: str, keep: str = "true") -> str:
    """``text`` with the matches that are to be kept in private characters."""
    pattern, plain = pattern.replace("'", "''"), PLAIN.replace("'", "''")
    return rf"""
  SELECT id, CASE WHEN regexp_matches(t, '{pattern}') THEN array_to_string(list_transform(range(1, len(p) + 1), lambda i:
    p[i] || CASE WHEN i > len(m) THEN '' WHEN {keep} THEN translate(m[i], '{plain}', '{TAKEN}') ELSE m[i] END), '') ELSE t END AS t
  FROM (SELECT id, t, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p FROM {text})"""


def _sql_matches(name: str, pattern: str, kind: int, keep: str = "true", of: str = "docs") -> str:
    pattern = pattern.replace("'", "''")
    return rf"""
{name} AS (
  SELECT id, start, start + length(value) AS "end", {kind} AS kind, value FROM (
    SELECT id, unnest(m) AS value,
      unnest(list_transform(range(1, len(m) + 1), lambda i: CAST(list_sum(list_transform(p[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT))) AS start
    FROM (SELECT id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p FROM {of}
      WHERE regexp_matches(t, '{pattern}')))
  WHERE {keep})"""


def _sql() -> str:
    assign = ASSIGN.replace("'", "''")
    terms = "[" + ", ".join(map(str, TERMS)) + "]"
    parts = [
        "docs AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents)",
        _sql_matches("assign", ASSIGN, 0, f"length(regexp_extract(value, '{assign}', 2)) >= {ASSIGN_VALUE}"),
        _sql_matches("access", ACCESS, 1),
        _sql_matches("hex", HEX, 2),
        f"fresh AS (SELECT id, translate(t, '{TAKEN}', '{OTHER * len(TAKEN)}') AS t FROM docs)",
        f"free1 AS ({_sql_taken('fresh', ASSIGN, f"length(regexp_extract(m[i], '{assign}', 2)) >= {ASSIGN_VALUE}")})",
        f"free2 AS ({_sql_taken('free1', ACCESS_EITHER)})",
        f"free3 AS ({_sql_taken('free2', HEX_EITHER)})",
        f"free4 AS ({_sql_taken('free3', ALLOW)})",
        _sql_matches(
            "candidate",
            CANDIDATE,
            3,
            "regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND (regexp_full_match(value, '[0-9A-Fa-f]+')"
            f" OR (regexp_matches(value, '{_IS_ONE_CASE}') AND length(regexp_replace(value, '[^0-9]', '', 'g')) >= {ONE_CASE_DIGITS})"
            " OR (regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')))",
            "free4",
        ),
        "base AS (SELECT id, start, kind, \"end\" FROM assign UNION ALL SELECT id, start, kind, \"end\" FROM access"
        " UNION ALL SELECT id, start, kind, \"end\" FROM hex)",
        f"""
windows AS (
  SELECT id, start, j, substr(value, CAST(j + 1 AS BIGINT), {WINDOW}) AS w,
    CASE WHEN regexp_full_match(value, '[0-9A-Fa-f]+') THEN {most_sum(HEX_BITS)}
      WHEN regexp_matches(value, '{_IS_ONE_CASE}') THEN {most_sum(ONE_CASE_BITS)} ELSE {most_sum(BASE64_BITS)} END AS most
  FROM (SELECT id, start, value, unnest(range(0, length(value) - {WINDOW - 1})) AS j FROM candidate))""",
        f"""
passing AS (
  SELECT id, start, j FROM windows
  WHERE list_sum(list_transform(list_distinct(string_split(w, '')), lambda c: {terms}[1 + length(w) - length(replace(w, c, '')) ])) <= most)""",
        f"""
runs AS (
  SELECT id, start + min(j) AS start, start + max(j) + {WINDOW} AS "end" FROM (
    SELECT id, start, j, sum(fresh) OVER (PARTITION BY id, start ORDER BY j) AS run FROM (
      SELECT id, start, j, CASE WHEN j <= lag(j) OVER (PARTITION BY id, start ORDER BY j) + {WINDOW} THEN 0 ELSE 1 END AS fresh
      FROM passing))
  GROUP BY id, start, run)""",
        """
every AS (
  SELECT id, start, kind, "end" FROM base
  UNION ALL SELECT r.id, r.start, 3, r."end" FROM runs r)""",
        """
named AS (
  SELECT id, start, kind, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || start || ':' || "end" AS s FROM every)""",
        """
folded AS (
  SELECT id, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h,
    string_agg(s, ',' ORDER BY start, kind) FILTER (kind < 3) AS b, string_agg(s, ',' ORDER BY start, kind) AS every
  FROM named GROUP BY id)""",
    ]
    return (
        "WITH "
        + ",\n".join(parts)
        + """
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(every, '') AS spans
FROM docs d LEFT JOIN folded f ON f.id = d.id"""
    )


@query("op8_secret_scan", _sql())
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts per pattern, a digest of their spans, all spans."""
    found = scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("secrets")).alias("spans"),
    )
