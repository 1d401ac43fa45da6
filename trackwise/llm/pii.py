"""Personal data in texts: patterns propose, checksums confirm, context scores.

Kinds: email, ip, card, phone (always reported once confirmed), and iban and ssn
(reported when their score reaches ``MIN_SCORE``). Cards pass the Luhn check,
ibans the mod-97 check at their country's length; words nearby raise or lower the score of a span. Native
columns only: each pattern runs on texts that pass a cheap necessary test.

The patterns are the plain ones made safe for long texts: possessive
repetition, and matches that cannot start inside a run whose start failed. They
find the same matches.

Defined results: null text is empty and has no spans. Places are code points,
end exclusive. Spans of different kinds may overlap; within a kind they do not.
Rows are independent (repeated rows give equal results), extra columns are kept;
columns named as the outputs are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import redact, with_matches

MIN_SCORE = 0.5
# Characters of an iban by country, as registered.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST",
    26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA",
    30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
IBAN_REST = "|".join(f"(?:{names})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_COUNTRIES.items())
#: Added or taken off for words in the context.
CONTEXT_STEP = 0.25


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    gate: str            # necessary pattern
    score: float
    near: str            # context that raises the score
    against: str = ""    # context that lowers it
    base: bool = False   # reported whatever the score


# Fixed patterns, kinds in output order.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", 0.9, r"mail|contact|write|reach", base=True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", 0.6, r"\bip\b|host|server|address|login", r"version|release|section", base=True),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
         r"[0-9](?:[\x20-]?[0-9]){11}", 0.7, r"card|visa|credit|payment|master", r"isbn|order|tracking", base=True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, r"phone|call|tel|mobile|fax", base=True),
    Kind("iban", rf"(?<![A-Za-z0-9])(?:{IBAN_REST})(?![A-Za-z0-9])",
         r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]", 0.7, r"iban|bank|account|konto|compte|cuenta"),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.35, r"ssn|social security|taxpayer"),
)
BASE_KINDS = tuple(k.name for k in KINDS if k.base)


def mod97(value: Column) -> Column:
    """Remainder of an account number (letters count from 10; the first four
    characters last) by 97."""
    v = F.regexp_replace(value, " ", "")
    v = F.concat(F.substring(v, 5, 40), F.substring(v, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substr(v, i, F.lit(1)))
        return F.when(code <= 57, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(v)), F.lit(0), step)


def _confirmed(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return mod97(value) == 1
    return F.lit(True)


def _confirming(kind: Kind):
    return lambda m: _confirmed(kind.name, m["value"])


def _scoring(rank: int, kind: Kind):
    def scored(m: Column) -> Column:
        context = F.lower(F.concat_ws(" ", m["before"], m["after"]))
        score = F.lit(kind.score) + F.when(context.rlike(kind.near), CONTEXT_STEP).otherwise(0.0)
        if kind.against:
            score -= F.when(context.rlike(kind.against), CONTEXT_STEP).otherwise(0.0)
        return F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"),
                        m["end"].alias("end"), m["value"].alias("value"), F.round(F.least(score, F.lit(1.0)), 4).alias("score"))
    return scored


def find_pii(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with ``out``: array of struct(start, rank, kind, end, value, score)
    sorted by start, then kind."""
    text = "__pii_text"
    df = docs.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    columns = []
    for rank, kind in enumerate(KINDS):
        raw = f"__pii_{kind.name}"
        gate = F.contains(F.col(text), F.lit(kind.gate)) if kind.gate == "@" else F.col(text).rlike(kind.gate)
        df = with_matches(df, text, raw, kind.pattern, gate)

        good = F.transform(F.filter(F.col(raw), _confirming(kind)), _scoring(rank, kind))
        if not kind.base:
            good = F.filter(good, lambda s: s["score"] >= MIN_SCORE)
        df = df.withColumn(raw, F.when(F.size(raw) > 0, good).otherwise(
            F.expr("CAST(array() AS array<struct<start:bigint,rank:int,kind:string,end:bigint,value:string,score:double>>)")))
        columns.append(raw)
    return df.withColumn(out, F.array_sort(F.concat(*columns))).drop(text, *columns)


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by its kind, e.g. <EMAIL>."""
    found = find_pii(docs, text_col, "__pii")
    return found.withColumn(text_col, F.when(F.size("__pii") > 0, redact(F.col(text_col), F.col("__pii"))).otherwise(
        F.col(text_col))).drop("__pii")
