"""Licence scan by sentence rules.

A text is cut into sentences at stops and blank lines; single line breaks and
the comment marks after them stand inside a sentence, as licence texts are
wrapped.  Each sentence is normalised and, if it is a known sentence of a
licence, becomes an identifier; of an unknown one each line is tried by itself,
for notices that end without a stop.  Rules are sequences of
identifiers; they are tried in order, longest first, on the sequence of a
document's identifiers, and take what they match out of it, so that a short
rule does not report again what a longer one has explained.  All of it is SQL
functions on whole texts; one pass, no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import read
from shelfwise.llm.registry import query

# Identifiers and the normalised sentences they stand for, as patterns of the whole sentence.
SENTENCES = (
    ("spdx_apache2", r"(.* )?spdx license identifier apache 2.0"),
    ("spdx_mit", r"(.* )?spdx license identifier mit"),
    ("spdx_bsd3", r"(.* )?spdx license identifier bsd 3 clause"),
    ("spdx_bsd2", r"(.* )?spdx license identifier bsd 2 clause"),
    ("spdx_gpl3", r"(.* )?spdx license identifier gpl 3.0( only| or later|\+)?"),
    ("spdx_gpl2", r"(.* )?spdx license identifier gpl 2.0( only| or later|\+)?"),
    ("apache2_short", r"(.* )?(licensed|released|distributed|available) under (the )?apache license( version)? v?2(.0)?( the license)?"),
    ("apache2_use", r"(and )?you may not use this file except in compliance with the license"),
    ("apache2_copy", r"you may obtain a copy of the license at.*"),
    ("apache2_asis", r"unless required by applicable law or agreed to in writing.*"),
    ("apache2_limits", r"see the license for the specific language governing permissions and limitations under the license"),
    ("mit_short", r"(.* )?(licensed|released|distributed|available) under (the )?(terms of the )?mit license.*"),
    ("mit_title", r"(the )?mit license( mit)?"),
    ("mit_grant", r"(.* )?permission is hereby granted free of charge to any person obtaining a copy of this software.*"),
    ("mit_notice", r"the above copyright notice and this permission notice shall be included in all copies.*"),
    ("asis_upper", r"the software is provided as is( without warranty of any kind.*| and the author disclaims all warranties.*)?"),
    ("isc_grant", r"(.* )?permission to use copy modify and(/or| or) distribute this software for any purpose.*"),
    ("bsd_grant", r"redistribution and use in source and binary forms with or without modification are permitted.*"),
    ("bsd_source", r"(1\.? )?redistributions of source code must retain the above copyright notice.*"),
    ("bsd_binary", r"(2\.? )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("bsd_names", r"(3\.? )?neither the name of .* may be used to endorse or promote products.*"),
    ("gpl3_short", r"(.* )?licensed under (the )?(terms of the )?gnu general public license( as published by the free software foundation)?( gpl)?( version| v)? ?3(.0)?"),
    ("gpl2_short", r"(.* )?licensed under (the )?(terms of the )?gnu general public license( as published by the free software foundation)?( gpl)?( version| v)? ?2(.0)?"),
    ("gpl_free", r"this (program|library|file) is free software( you can redistribute it and or modify it under the terms of the gnu general public license.*)?"),
    ("gpl3_version", r"(you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation )?(either )?version 3 of the license or at your option any later version"),
    ("gpl2_version", r"(you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation )?(either )?version 2 of the license or at your option any later version"),
    ("gpl3_only", r"you can redistribute it and/or modify it under the terms of the gnu general public license version 3 as published by the free software foundation"),
    ("gpl2_only", r"you can redistribute it and/or modify it under the terms of the gnu general public license version 2 as published by the free software foundation"),
    ("gpl_hope", r"this (program|library) is distributed in the hope that it will be useful but without any warranty.*"),
    ("lgpl_short", r"(.* )?(licensed|released|distributed) under (the )?(terms of the )?gnu lesser general public license.*"),
    ("agpl_short", r"(.* )?(licensed|released|distributed) under (the )?(terms of the )?gnu affero general public license.*"),
    ("mpl2", r"this source code form is subject to the terms of the mozilla public license.*"),
    ("cc0", r"(.* )?(dedicated to the public domain|licensed under (the )?cc0.*)"),
    ("cc_by_nc", r"(.* )?licensed under (a |the )?(cc|creative commons) (by nc|attribution non ?commercial)( (sa|nd))?( [0-9.]+)?.*"),
    ("cc_by_sa", r"(.* )?licensed under (a |the )?(cc|creative commons) (by sa|attribution share ?alike)( [0-9.]+)?.*"),
    ("cc_by", r"(.* )?licensed under (a |the )?(cc|creative commons) (by|attribution)( [0-9.]+)?.*"),
    ("reserved", r"(.* )?all rights reserved"),
    ("other", r".*(licensed|released|distributed) under .*|.* license( agreement)?( version)?( [0-9.]+)?"),
)
# Licences and the sequences of identifiers that show them, most specific first.
RULES = (
    ("Apache-2.0", ("apache2_short", "apache2_use", "apache2_copy", "apache2_asis", "apache2_limits")),
    ("Apache-2.0", ("apache2_short", "apache2_use", "apache2_copy", "apache2_asis")),
    ("MIT", ("mit_title", "reserved", "mit_grant", "mit_notice", "asis_upper")),
    ("MIT", ("mit_title", "mit_grant", "mit_notice", "asis_upper")),
    ("MIT", ("reserved", "mit_grant", "mit_notice", "asis_upper")),
    ("MIT", ("mit_grant", "mit_notice", "asis_upper")),
    ("BSD-3-Clause", ("reserved", "bsd_grant", "bsd_source", "bsd_binary", "bsd_names")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names")),
    ("BSD-2-Clause", ("reserved", "bsd_grant", "bsd_source", "bsd_binary")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl3_version", "gpl_hope")),
    ("GPL-2.0-or-later", ("gpl_free", "gpl2_version", "gpl_hope")),
    ("GPL-3.0-only", ("gpl_free", "gpl3_only", "gpl_hope")),
    ("GPL-2.0-only", ("gpl_free", "gpl2_only", "gpl_hope")),
    ("GPL-3.0-only", ("gpl_free", "gpl3_only")),
    ("GPL-2.0-only", ("gpl_free", "gpl2_only")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl3_version")),
    ("GPL-2.0-or-later", ("gpl_free", "gpl2_version")),
    ("ISC", ("isc_grant", "asis_upper")),
    ("Apache-2.0", ("spdx_apache2",)),
    ("MIT", ("spdx_mit",)),
    ("BSD-3-Clause", ("spdx_bsd3",)),
    ("BSD-2-Clause", ("spdx_bsd2",)),
    ("GPL-3.0", ("spdx_gpl3",)),
    ("GPL-2.0", ("spdx_gpl2",)),
    ("Apache-2.0", ("apache2_short",)),
    ("MIT", ("mit_short",)),
    ("GPL-3.0", ("gpl3_short",)),
    ("GPL-2.0", ("gpl2_short",)),
    ("LGPL", ("lgpl_short",)),
    ("AGPL", ("agpl_short",)),
    ("MPL-2.0", ("mpl2",)),
    ("CC0-1.0", ("cc0",)),
    ("CC-BY-NC", ("cc_by_nc",)),
    ("CC-BY-SA", ("cc_by_sa",)),
    ("CC-BY", ("cc_by",)),
    ("proprietary", ("reserved",)),
    ("unknown", ("other",)),
)
#: The beginning of a line with the marks of a comment, whatever the language.
LINE_START = r"(?:^|\n)[\x20\t]*(?:/\*+|\*+/|\*+|//+|#+|;+|%+|--+|<!--+|dnl\x20|[Rr][Ee][Mm]\x20)?[\x20\t]*"
#: Ends of sentences: stops before white space or the end, and blank lines.
SENTENCE_END = r"[.!?;:]+(?:[\x20\t\n]+|$)|[\x20\t]*\n(?:[\x20\t]*\n)+"
#: A sentence without any of these words cannot be a known one; most texts have none.  Words may be wrapped.
CUE = "(?i)" + (
    r"licens|rights reserved|hereby granted|copyright notice|redistribution|free software|permission to use|public domain|as is|written consent"
    r"|compliance|applicable law|obtain a copy|neither the name|any later version|without any warranty|the terms of the gnu"
).replace(" ", "[^a-zA-Z0-9]+")


def normalised(sentence: Column) -> Column:
    """Lower case; letters, digits, dots inside numbers, slashes and plus signs; single spaces."""
    plain = F.regexp_replace(F.lower(sentence), r"[^a-z0-9.+/]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, r"[.]+(\x20|$)", " "), r"\x20+", " "))


def identifier(sentence: Column) -> Column:
    """Identifier of a normalised sentence; null for an unknown one."""
    return reduce(
        lambda rest, s: F.when(sentence.rlike(f"^(?:{s[1]})$"), F.lit(s[0])).otherwise(rest),
        reversed(SENTENCES),
        F.lit(None).cast("string"),
    )


def unwrapped(text: Column) -> Column:
    """The text with plain line breaks, and without comment marks at the beginning of lines."""
    return F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), LINE_START, "\n")


def sentence_ids(text: Column) -> Column:
    """Identifiers of a text's known sentences, in order; empty for null."""
    text = F.coalesce(text, F.lit(""))
    sentences = F.filter(F.split(unwrapped(text), SENTENCE_END, -1), lambda s: s.rlike(CUE))
    none = F.array().cast("array<string>")
    known = F.transform(sentences, lambda s: F.struct(s.alias("s"), identifier(normalised(s)).alias("i")))

    def of(x: Column) -> Column:
        lines = F.filter(F.split(x["s"], "\n"), lambda line: line.rlike(CUE))
        lines = F.filter(F.transform(lines, lambda line: identifier(normalised(line))), lambda i: i != "other")
        whole = F.when(x["i"].isNull(), none).otherwise(F.array(x["i"]))
        sure = F.coalesce(x["i"] != "other", F.lit(False)) | ~x["s"].contains("\n")
        return F.when(sure, whole).otherwise(F.when(F.size(lines) > 0, lines).otherwise(whole))

    return F.when(text.rlike(CUE), F.flatten(F.transform(known, of))).otherwise(none)


def licences(ids: Column) -> Column:
    """Names of the licences whose rules match the identifiers, in the order of the rules, each once."""
    rules = F.array(*[
        F.struct(F.lit("".join(f"|{i}|" for i in ids)).alias("rule"), F.lit(name).alias("name")) for name, ids in RULES
    ])
    # Each identifier stands between bars of its own: |a||b||c|.
    marked = F.array_join(F.transform(ids, lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "")
    begin = F.struct(marked.alias("left"), F.array().cast("array<string>").alias("names"))
    found = F.aggregate(
        rules,
        begin,
        lambda state, r: F.struct(
            F.replace(state["left"], r["rule"], F.lit(" ")).alias("left"),
            F.when(F.contains(state["left"], r["rule"]), F.concat(state["names"], F.array(r["name"])))
            .otherwise(state["names"])
            .alias("names"),
        ),
        lambda state: F.array_distinct(state["names"]),
    )
    return F.when(F.size(ids) > 0, found).otherwise(F.array().cast("array<string>"))


def scan(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with sentence_ids and licences, both arrays; empty for null and empty texts.

    They take the place of input columns of the same names.  Rows stand for
    themselves: repeats repeat their result, an empty table gives none.
    """
    return df.withColumn("sentence_ids", sentence_ids(F.col(text_col))).withColumn("licences", licences(F.col("sentence_ids")))


def _sql() -> str:
    cases = "\n".join(f"    WHEN regexp_full_match(n, '{p}') THEN '{i}'" for i, p in SENTENCES)
    steps, before = [], "marked"
    for k, (name, ids) in enumerate(RULES):
        rule = "".join(f"|{i}|" for i in ids)
        steps.append(
            f"r{k} AS (SELECT doc_id, id, ids, replace(l, '{rule}', ' ') AS l, CASE WHEN contains(l, '{rule}')"
            f" THEN list_append(names, '{name}') ELSE names END AS names FROM {before})"
        )
        before = f"r{k}"
    return (
        f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
sentences AS (
  SELECT id, k, s FROM (SELECT id, unnest(p) AS s, unnest(range(len(p))) AS k FROM (
    SELECT id, string_split_regex(regexp_replace(regexp_replace(t, '\\r\\n?', chr(10), 'g'), '{LINE_START}', chr(10), 'g'), '{SENTENCE_END}') AS p
    FROM docs WHERE regexp_matches(t, '{CUE}')))
  WHERE regexp_matches(s, '{CUE}')),
parts AS (
  SELECT id, k, 0 AS line, s FROM sentences
  UNION ALL SELECT id, k, line, s FROM (
    SELECT id, k, unnest(p) AS s, unnest(range(1, len(p) + 1)) AS line FROM (
      SELECT id, k, string_split(s, chr(10)) AS p FROM sentences WHERE contains(s, chr(10))))
    WHERE regexp_matches(s, '{CUE}')),
plain AS (
  SELECT id, k, line, trim(regexp_replace(regexp_replace(regexp_replace(lower(s), '[^a-z0-9.+/]+', ' ', 'g'), '[.]+(\\x20|$)', ' ', 'g'), '\\x20+', ' ', 'g')) AS n
  FROM parts),
named AS (
  SELECT id, k, line, CASE
{cases} END AS i FROM plain),
known AS (
  SELECT id, k, line, i, max(i) FILTER (line = 0) OVER (PARTITION BY id, k) AS whole,
    count(i) FILTER (line > 0 AND i <> 'other') OVER (PARTITION BY id, k) AS lines FROM named),
folded AS (
  SELECT id, list(i ORDER BY k, line) AS ids FROM known
  WHERE i IS NOT NULL AND CASE WHEN coalesce(whole, 'other') <> 'other' OR lines = 0 THEN line = 0 ELSE line > 0 AND i <> 'other' END GROUP BY id),
marked AS (
  SELECT d.doc_id, d.id, coalesce(ids, []) AS ids, coalesce(list_reduce(list_transform(ids, lambda x: '|' || x || '|'), lambda a, b: a || b), '') AS l,
    CAST([] AS VARCHAR[]) AS names
  FROM docs d LEFT JOIN folded f ON f.id = d.id),
"""
        + ",\n".join(steps)
        + f"""
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
  coalesce(array_to_string(list_filter(names, lambda x, k: list_position(names, x) = k), ','), '') AS licences
FROM {before}"""
    )


@query("op1_license_sentence_rules", _sql())
def op1_license_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence sentences and licences of every document."""
    return scan(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
    )
