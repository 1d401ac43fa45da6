"""Licence marks in texts: ordered signature rules over words.

A text is its words (letters, digits and non-ASCII characters, A-Z lower-cased)
joined by single spaces. Base phrases are always reported. The method's rules
are regular expressions over the joined words, built from a table of licences
and templates: identifier, name with version, "licensed under" name, bare name.
A rule runs only on texts that hold its keyword, and only texts that hold any
keyword are searched at all. Detections are intervals of words; one inside
another of the same or a higher rank (lower number) is suppressed, so "gpl"
gives way to "gnu general public license version 2". Native columns only; the
rules enter the plan as one constant array.

Defined results: null text is empty: no words, no labels, score 0. Rows are
independent; extra columns are kept, columns named as the outputs are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import running_totals, with_matches

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of the raw text: as after lower-casing, with A-Z.
RAW_WORD = r"[\p{Alnum}\x{80}-\x{10FFFF}]+"

# Fixed base phrases and labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Licences: label, names (each a keyword that a matching text holds and a pattern over words), versions.
LICENCES = (
    ("gpl", (("general public", r"(?:gnu )?general public licen[sc]e"), ("gpl", r"(?:gnu )?gpl")), ("1", "2", "3")),
    ("lgpl", (("general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e"), ("lgpl", r"(?:gnu )?lgpl")), ("2", "2 1", "3")),
    ("agpl", (("affero", r"(?:gnu )?affero general public licen[sc]e"), ("agpl", r"(?:gnu )?agpl")), ("1", "3")),
    ("fdl", (("free documentation", r"(?:gnu )?free documentation licen[sc]e"),), ("1 1", "1 2", "1 3")),
    ("apache", (("apache", r"apache(?: software)?(?: licen[sc]e)?"),), ("1 0", "1 1", "2", "2 0")),
    ("mpl", (("mozilla public", r"mozilla public licen[sc]e"), ("mpl licen", r"mpl licen[sc]e")), ("1 0", "1 1", "2 0")),
    ("epl", (("eclipse public", r"eclipse public licen[sc]e"), ("epl licen", r"epl licen[sc]e")), ("1 0", "2 0")),
    ("cddl", (("common development", r"common development and distribution licen[sc]e"), ("cddl licen", r"cddl licen[sc]e")), ("1 0", "1 1")),
    ("cpl", (("common public", r"common public licen[sc]e"),), ("0 5", "1 0")),
    ("ipl", (("ibm public", r"ibm public licen[sc]e"),), ("1 0",)),
    ("eupl", (("european union public", r"european union public licen[sc]e"), ("eupl licen", r"eupl licen[sc]e")), ("1 0", "1 1", "1 2")),
    ("osl", (("open software", r"open software licen[sc]e"),), ("1 0", "2 0", "2 1", "3 0")),
    ("afl", (("academic free", r"academic free licen[sc]e"),), ("1 1", "2 0", "2 1", "3 0")),
    ("artistic", (("artistic", r"artistic licen[sc]e"),), ("1 0", "2 0")),
    ("bsl", (("boost software", r"boost software licen[sc]e"),), ("1 0",)),
    ("bsd", (("bsd", r"bsd(?: style)?(?: licen[sc]e)?"),), ("2 clause", "3 clause", "4 clause")),
    ("mit", (("mit ", r"mit(?: style)? licen[sc]e"),), ()),
    ("isc", (("isc licen", r"isc licen[sc]e"),), ()),
    ("zlib", (("zlib", r"zlib (?:libpng )?licen[sc]e"),), ()),
    ("unlicense", (("unlicense", r"(?:the )?unlicense"),), ()),
    ("ofl", (("open font", r"(?:sil )?open font licen[sc]e"),), ("1 0", "1 1")),
    ("psf", (("python", r"python(?: software foundation)? licen[sc]e"),), ("2", "2 0")),
    ("php", (("php", r"php licen[sc]e"),), ("3 0", "3 01")),
    ("openssl", (("openssl", r"openssl licen[sc]e"),), ()),
    ("ms-pl", (("microsoft public", r"microsoft public licen[sc]e"),), ()),
    ("ms-rl", (("microsoft reciprocal", r"microsoft reciprocal licen[sc]e"),), ()),
    ("odbl", (("open database", r"open database licen[sc]e"),), ("1 0",)),
    ("odc-by", (("open data commons", r"open data commons attribution licen[sc]e"),), ("1 0",)),
    ("pddl", (("dedication and", r"public domain dedication and licen[sc]e"),), ("1 0",)),
    ("cc0", (("cc0", r"(?:creative commons )?cc0"),), ("1 0",)),
    ("cc-by", (("cc by", r"cc by"), ("creative commons", r"creative commons (?:by|attribution)")), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", (("cc by sa", r"cc by sa"), ("creative commons", r"creative commons (?:by sa|attribution share ?alike)")), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", (("cc by nc", r"cc by nc"), ("creative commons", r"creative commons (?:by nc|attribution non ?commercial)")), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", (("cc by nd", r"cc by nd"), ("creative commons", r"creative commons (?:by nd|attribution no ?deriv(?:ative)?s)")), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", (("cc by nc sa", r"cc by nc sa"), ("creative commons", r"creative commons (?:by nc sa|attribution non ?commercial share ?alike)")), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", (("cc by nc nd", r"cc by nc nd"), ("creative commons", r"creative commons (?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s)")), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("ecl", (("educational community", r"educational community licen[sc]e"),), ("1 0", "2 0")),
    ("qpl", (("q public", r"q public licen[sc]e"),), ("1 0",)),
    ("zpl", (("zope public", r"zope public licen[sc]e"),), ("1 1", "2 0", "2 1")),
    ("upl", (("universal permissive", r"universal permissive licen[sc]e"),), ("1 0",)),
)
# Phrases without a name: label, keyword, pattern, rank.
PHRASES = (
    ("permissive-grant", "hereby granted", r"permission is hereby granted(?: free of charge)?", 3),
    ("redistribution-terms", "redistribution", r"redistribution and use in source and binary forms", 3),
    ("reserved", "rights reserved", r"(?:all|some|no) rights reserved", 4),
    ("copyright", "copyright", r"copyright (?:c )?(?:\d{4}|by|holder|notice)(?: \d{4})*", 4),
    ("public-domain", "public domain", r"(?:in|into|to) the public domain", 3),
    ("proprietary", "proprietary", r"proprietary and confidential", 3),
    ("non-commercial", "commercial", r"(?:non commercial|noncommercial) (?:use|purposes) only", 3),
    ("no-derivatives", "derivative", r"no derivative(?:s| works)", 3),
    ("trade-secret", "trade secret", r"trade secrets? of", 4),
)
#: Confidence of a detection by rank.
RANK_SCORE = (1.0, 0.95, 0.9, 0.7, 0.5)
#: Confidence of a base phrase.
BASE_SCORE = 0.8
#: Texts whose lower-cased form holds none of these have no mark ...
GATE = ("licens", "licenc", "gpl", "apache", "bsd", "creative", "cc0", "reserved", "copyright", "hereby", "redistribution", "domain",
        "proprietary", "trade secret", "commercial", "derivative")
#: ... unless they match this.
GATE_PATTERN = r"(?i)cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++by"


def rules() -> list[tuple[str, str, str, int]]:
    """(label, keyword, pattern, rank), best rank first."""
    out = []
    for label, names, versions in LICENCES:
        spdx = label.replace("-", " ")
        for v in versions:
            clause = "clause" in v
            versioned = f"{label}-{v.replace(' ', '-' if clause else '.')}"
            out.append((versioned, "spdx", f"spdx license identifier {spdx} {v}(?: only| or later)?", 0))
            for keyword, name in names:
                pattern = f"(?:{name} {v}|{v} {name})" if clause else (
                    f"{name}(?: (?:version|v|ver|international))? v?{v}(?! [0-9])(?: or(?: at your option)?(?: any)? later(?: version)?)?")
                out.append((versioned, keyword, pattern, 1))
        out.append((label, "spdx", f"spdx license identifier {spdx}", 0))
        for keyword, name in names:
            out.append((label, keyword, f"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{name}", 2))
            out.append((label, keyword, name, 3))
    out += [(label, keyword, pattern, rank) for label, keyword, pattern, rank in PHRASES]
    return sorted(out, key=lambda r: r[3])


def gate(text: Column) -> Column:
    low = F.lower(text)
    held = F.contains(low, F.lit(GATE[0]))
    for word in GATE[1:]:
        held = held | F.contains(low, F.lit(word))
    return held | (F.contains(low, F.lit("cc")) & text.rlike(GATE_PATTERN))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _rule_table() -> Column:
    """The rules as a constant array of struct(label, keyword, pattern, rank)."""
    fields = zip(*[(label, keyword, f"(?<= ){pattern}(?= )", str(rank)) for label, keyword, pattern, rank in rules()])
    lists = [F.split(F.lit("\n".join(f)), "\n") for f in fields]
    return F.transform(F.arrays_zip(*(c.alias(n) for c, n in zip(lists, ("label", "keyword", "pattern", "rank")))),
                       lambda r: F.struct(r["label"].alias("label"), r["keyword"].alias("keyword"), r["pattern"].alias("pattern"),
                                          r["rank"].cast("int").alias("rank")))


def _places(joined: Column):
    """Intervals of words that a rule matches."""
    def run(rule: Column) -> Column:
        found = F.regexp_extract_all(joined, rule["pattern"], F.lit(0))
        gaps = F.split(joined, rule["pattern"], -1)
        return F.when(F.size(found) > 0, F.flatten(F.transform(F.array(F.struct(found.alias("m"), gaps.alias("g"))), lambda x: F.zip_with(
            F.zip_with(x["m"], F.slice(x["g"], 1, F.size(x["m"])), lambda m, g: F.struct(_spaces(m).alias("m"), _spaces(g).alias("g"))),
            running_totals(F.zip_with(x["m"], F.slice(x["g"], 1, F.size(x["m"])), lambda m, g: _spaces(m) + _spaces(g))),
            lambda s, before: F.struct((before + s["g"] - 1).alias("start"), (-(before + s["g"] + s["m"])).alias("minus_end"),
                                       rule["rank"].alias("rank"), rule["label"].alias("label")))))).otherwise(
            F.expr("CAST(array() AS array<struct<start:bigint,minus_end:bigint,rank:int,label:string>>)"))
    return run


def _uncovered(sorted_marks: Column) -> Column:
    """Drops intervals inside one kept before of the same or a higher rank. The
    marks are sorted by start, then end downwards, then rank, so one kept before
    covers a mark if it reaches as far: the furthest end kept of each rank decides."""
    kept = "CAST(array() AS array<struct<start:bigint,minus_end:bigint,rank:int,label:string>>)"
    start = F.struct(F.array_repeat(F.lit(1).cast("long"), len(RANK_SCORE)).alias("ends"), F.expr(kept).alias("kept"))

    def step(acc: Column, m: Column) -> Column:
        inside = F.array_min(F.slice(acc["ends"], 1, m["rank"] + 1)) <= m["minus_end"]
        further = F.transform(acc["ends"], lambda e, i: F.when(i == m["rank"], F.least(e, m["minus_end"])).otherwise(e))
        return F.struct(F.when(inside, acc["ends"]).otherwise(further).alias("ends"),
                        F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(m))).alias("kept"))

    return F.aggregate(sorted_marks, start, step, lambda acc: acc["kept"])


def find_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, base (array of struct(start, end, label)), marks (the
    method's detections, array of struct(start, end, rank, label)), places in words."""
    text, words, joined = "__lic_text", "__lic_words", "__lic_joined"
    df = docs.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df = df.withColumn(words, F.regexp_extract_all(text, F.lit(RAW_WORD), F.lit(0)))
    df = df.withColumn("n_words", F.size(words).cast("long")).withColumn(joined, F.when(gate(F.col(text)), F.concat(
        F.lit(" "), F.translate(F.array_join(words, " "), UPPER, UPPER.lower()), F.lit(" ")))).drop(words)
    columns = []
    for i, (phrase, label) in enumerate(BASE):
        name = f"__lic_base{i}"
        df = with_matches(df, joined, name, f"(?<= ){phrase}(?= )", F.contains(joined, F.lit(f" {phrase} ")), measure=_spaces, context=0)
        df = df.withColumn(name, F.transform(name, _labelled(label)))
        columns.append(name)
    df = df.withColumn("base", F.array_sort(F.concat(*columns))).drop(*columns)
    marks = F.flatten(F.transform(F.filter(_rule_table(), lambda r: F.contains(F.col(joined), r["keyword"])), _places(F.col(joined))))
    df = df.withColumn("__lic_marks", F.when(F.col(joined).isNotNull(), F.array_sort(marks)).otherwise(
        F.expr("CAST(array() AS array<struct<start:bigint,minus_end:bigint,rank:int,label:string>>)")))
    return df.withColumn("marks", F.transform(_uncovered(F.col("__lic_marks")), lambda m: F.struct(
        m["start"].alias("start"), (-m["minus_end"]).alias("end"), m["rank"].alias("rank"), m["label"].alias("label")))).drop(
        text, joined, "__lic_marks")


def _labelled(label: str):
    return lambda m: F.struct((m["start"] - 1).alias("start"), m["end"].alias("end"), F.lit(label).alias("label"))


def license_score(base: Column, marks: Column) -> Column:
    """Confidence 0 to 1 of the best detection."""
    scores = F.concat(F.transform(base, lambda _: F.lit(BASE_SCORE)),
                      F.transform(marks, lambda m: F.element_at(F.array(*(F.lit(s) for s in RANK_SCORE)), m["rank"] + 1)))
    return F.coalesce(F.array_max(scores), F.lit(0.0))
