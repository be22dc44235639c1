"""Personal data in texts, with built-in functions only.

Regular expressions propose spans, checksums and ranges confirm them, and words nearby
adjust a score. Spans come from the matches and the pieces between them: the lengths of
both, added up, are the positions. All patterns are possessive and none can be tried
again inside a run of its own characters, so that very long words cost linear time;
``\\G`` admits a match right behind the previous one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, in possessive form.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The method's own additions: account numbers with their check digits.
IBAN = r"\b[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b"
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban")
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|contact|write|reach|kontakt|courriel|correo)\b",
    "ip": r"(?i)\b(?:ip|address|host|server|login|adresse)\b",
    "card": r"(?i)\b(?:card|credit|visa|master|payment|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|call|tel|mobile|fax|telefon|t[ée]l[ée]phone|tel[ée]fono)\b",
    "iban": r"(?i)\b(?:iban|account|bank|transfer|konto|compte|cuenta)\b",
}
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
NEARBY = 40  # code points on either side


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a run of digits is right."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda a, i: a
        + F.element_at(
            F.array(*[F.lit(x) for x in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
            F.substring(digits, F.length(digits) + 1 - i, F.lit(1)).cast("int") + F.when(i % 2 == 0, 11).otherwise(1),
        ),
    )
    return total % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number, read as digits from its fifth character, leaves 1."""
    plain = F.regexp_replace(code, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.split(turned, "(?<=.)(?=.)"),
        F.lit(0),
        lambda a, c: F.when(c.rlike("^[0-9]$"), (a * 10 + F.ascii(c) - 48) % 97).otherwise(
            (a * 100 + F.ascii(c) - 55) % 97
        ),
    )
    return rest == 1


def _right(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # Leading zeros do not count; three digits fit an integer.
        part = F.transform(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(part, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))
    if kind == "iban":
        return mod97(found)
    digits = digits_of(found)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)


def spans(text: Column, kind: str) -> Column:
    """Array of ``start, end, score`` of the confirmed matches of one kind."""
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN}[kind]
    needed = {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, text.rlike({"ip": r"[0-9]\.[0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "iban": "[A-Z]{2}[0-9]{2}"}.get(kind, "")))
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # One piece before each match and one after the last.
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    rows = F.aggregate(
        F.arrays_zip(matches.alias("m"), F.slice(gaps, F.lit(1), F.size(matches)).alias("g")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,found:string>>").alias("rows")),
        lambda a, x: F.struct(
            (a["at"] + x["g"] + F.length(x["m"])).alias("at"),
            F.concat(a["rows"], F.array(F.struct((a["at"] + x["g"]).alias("start"), (a["at"] + x["g"] + F.length(x["m"])).alias("end"), x["m"].alias("found")))).alias("rows"),
        ),
    )["rows"]
    kept = F.filter(rows, lambda s: _right(kind, s["found"]))

    def scored(s):
        first = F.greatest(s["start"] - NEARBY, F.lit(0))
        around = F.concat(F.substring(text, first + 1, s["start"] - first), F.lit(" "), F.substring(text, s["end"] + 1, F.lit(NEARBY)))
        score = F.lit(START[kind]) + F.when(around.rlike(CONTEXT[kind]), 0.1 if START[kind] >= 0.9 else 0.2).otherwise(0.0)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.round(score, 2).alias("score"))

    none = F.array().cast("array<struct<start:int,end:int,score:double>>")
    return F.when(needed, F.transform(kept, scored)).otherwise(none)


def _joined(kinds, field: str | None = None) -> Column:
    def named(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"], *([s[field]] if field else [])))

    return F.concat_ws(",", F.concat(*map(named, kinds)))


def find_personal_data(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts and spans of personal data in each whole text, beside the columns ``keep``.

    Adds one array of ``start, end, score`` per kind (code points, end exclusive), the
    counts ``n_email, n_ip, n_card, n_phone, n_iban``, ``base_sha256`` (of the base spans
    as ``kind:start:end``), ``spans`` (all spans) and ``scores``. A null text counts as
    empty and has no spans. One row per input row.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Columns of ``keep`` that bear a name made here give way to it.
    out = docs.select(*[F.col(c) for c in keep if c not in KINDS], *[spans(text, k).alias(k) for k in KINDS])
    return out.select(
        "*",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(BASE), 256).alias("base_sha256"),
        _joined(KINDS).alias("spans"),
        _joined(KINDS, "score").alias("scores"),
    )


def mask_personal_data(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` with confirmed spans of score ``least`` or more replaced by ``<KIND>``.

    Same rows and columns. Of overlapping spans the earliest counts, the longer one if
    two start together. A null text stays null.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def listed(kind: str) -> Column:
        sure = F.filter(spans(text, kind), lambda s: s["score"] >= least)
        return F.transform(sure, lambda s: F.struct(s["start"], (-s["end"]).alias("back"), F.lit(kind).alias("kind")))

    found = F.concat(*map(listed, KINDS))
    done = F.aggregate(
        F.array_sort(found),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                (-s["back"]).alias("at"),
                F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")).alias("out"),
            ),
        ).otherwise(a),
    )
    masked = F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    changed = F.when(F.col("text").isNotNull(), F.when(F.size(found) > 0, masked).otherwise(text))
    return docs.select(*[changed.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
