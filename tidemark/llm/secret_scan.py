"""Secrets in texts, by patterns and by sliding-window entropy; Spark functions only, no shuffle.

Patterns give spans of the kinds assign, access and hex. The method adds the kind entropy: long
runs of key characters with both letters and digits are candidates; a window of `WINDOW` characters
slides over each, counts of characters and the sum of c * log2(c) are kept up to date as one
character enters and one leaves, and a candidate whose largest window entropy (in bits) reaches the
threshold of its character class is a secret, unless a pattern span touches it. The allow list takes
out of a candidate only what it names, a leading date or the whole part (letters and digits between
other signs) that holds a word of it; what is left around that is judged like candidates of its own.
Only an identifier that is the whole candidate clears all of it.

Spans count code points, end exclusive. Defined results: a null text is the empty one and has no
spans; repeated rows give a row each; an empty table gives an empty result; other columns are kept
by `redacted` and not read otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

WINDOW = 20
PIECE = 128
_KEY = "A-Za-z0-9+/=_-"
CANDIDATE = rf"(?<![{_KEY}])(?=[A-Za-z+/=_-]*[0-9])(?=[0-9+/=_-]*[A-Za-z])[{_KEY}]{{{WINDOW},}}"
#: Character classes and the entropy in bits that a window must reach; the first class that fits holds.
CLASSES = ((r"^[0-9a-fA-F]+$", 2.9), (r"^[A-Z0-9]+$", 3.4), (r"^", 3.75))
#: Candidates that are no secrets as a whole: identifiers.
IDENTIFIER = r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
#: What is no secret inside a candidate: a leading date, and parts made to be examples.
ALLOWED_WORDS = "example|sample|dummy|placeholder|xxxx|0123456789|abcdefgh"
ALLOWED = rf"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|(?<![0-9A-Za-z])(?i:[0-9a-z]*(?:{ALLOWED_WORDS})[0-9a-z]*)"
_FIRST_CODE, _CODES = 43, 80  # from "+" to "z"
MARK = "[SECRET]"
_PLACES = "array<struct<start:bigint,end:bigint,value:string>>"


def _places(text: Column, pattern: str, group: int | None = None) -> Column:
    """Array of (start, end, value) of all matches: what lies between matches gives their places."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    steps = F.arrays_zip(between.alias("gap"), found.alias("found"), value.alias("value"))
    steps = F.slice(steps, 1, F.size(found))
    out = F.aggregate(
        steps,
        F.expr(f"named_struct('at', 0L, 'spans', cast(array() as {_PLACES}))"),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["gap"]) + F.length(x["found"])).alias("at"),
            F.concat(s["spans"], F.array(F.struct(
                (s["at"] + F.length(x["gap"])).alias("start"),
                (s["at"] + F.length(x["gap"]) + F.length(x["found"])).alias("end"),
                x["value"].alias("value"),
            ))).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return F.when(text.rlike(pattern), out).otherwise(F.expr(f"cast(array() as {_PLACES})"))


def _spans(places: Column, kind: str) -> Column:
    return F.transform(places, lambda x: F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"), x["end"].alias("end"),
    ))


def window_entropy(value: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits, of a window that slides over a string of key characters.

    A string shorter than the window has entropy 0. The window slides over pieces of `PIECE`
    characters that overlap by all but one of its own, so work stays in proportion to the length.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.length(value) - window), F.lit(PIECE - window + 1))
    return F.array_max(F.transform(
        F.transform(starts, lambda i: F.substring(value, i + 1, F.lit(PIECE))), lambda piece: _piece_entropy(piece, window)
    ))


def _piece_entropy(value: Column, window: int) -> Column:
    parts = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    chars = F.split(value, "")
    code = lambda c: F.ascii(c) - _FIRST_CODE + 1

    def step(s, p):
        new = code(F.element_at(s["chars"], p))
        old = F.when(p > window, code(F.element_at(s["chars"], F.greatest(p - window, F.lit(1))))).otherwise(F.lit(0))
        n_new = F.element_at(s["counts"], new)
        n_old = F.element_at(s["counts"], F.greatest(old, F.lit(1)))
        gain = F.element_at(parts, n_new + 2) - F.element_at(parts, n_new + 1)
        loss = F.when(old > 0, F.element_at(parts, n_old) - F.element_at(parts, n_old + 1)).otherwise(0.0)
        total = F.when(new == old, s["total"]).otherwise(s["total"] + gain + loss)
        entropy = F.when(p >= window, math.log2(window) - total / window).otherwise(0.0)
        counts = F.transform(s["counts"], lambda c, i: c + (i + 1 == new).cast("int") - (i + 1 == old).cast("int"))
        return F.struct(
            s["chars"].alias("chars"), counts.alias("counts"), total.alias("total"), F.greatest(s["best"], entropy).alias("best")
        )

    start = F.struct(
        chars.alias("chars"), F.array_repeat(F.lit(0), _CODES).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best")
    )
    return F.aggregate(F.sequence(F.lit(1), F.length(value)), start, step, lambda s: s["best"])


def _reaches(run: Column) -> Column:
    """Whether a run of key characters has letters, digits and a window of enough entropy for its class."""
    bound = F.lit(CLASSES[-1][1])
    for pattern, bits in reversed(CLASSES[:-1]):
        bound = F.when(run.rlike(pattern), F.lit(bits)).otherwise(bound)
    mixed = (F.length(run) >= WINDOW) & run.rlike("[0-9]") & run.rlike("[A-Za-z]")
    return F.when(mixed, window_entropy(run) >= bound).otherwise(False)


def _is_secret(value: Column) -> Column:
    left = F.when(value.rlike(IDENTIFIER), F.lit("")).otherwise(F.regexp_replace(value, ALLOWED, " "))
    return F.exists(F.split(left, " "), _reaches)


def with_spans(docs: DataFrame) -> DataFrame:
    """`docs` with _base and _spans: arrays of (start, order, end), sorted by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.withColumns({
        "_assign": F.filter(_places(text, ASSIGN, 2), lambda x: F.length(x["value"]) >= ASSIGN_LENGTH),
        "_access": F.filter(_places(text, ACCESS), lambda x: x["end"] - x["start"] >= ACCESS_LENGTH),
        # only runs of the least length are looked for: shorter ones would be dropped
        "_hex": _places(text, HEX.replace("+", f"{{{HEX_LENGTH},}}")),
        "_high": F.filter(_places(text, CANDIDATE), lambda x: _is_secret(x["value"])),
    })
    found = found.withColumn("_base", F.array_sort(F.concat(
        _spans(F.col("_assign"), "assign"), _spans(F.col("_access"), "access"), _spans(F.col("_hex"), "hex")
    )))
    free = F.filter(_spans(F.col("_high"), "entropy"), lambda e: ~F.exists(
        "_base", lambda b: (e["start"] < b["end"]) & (b["start"] < e["end"])
    ))
    return found.withColumn("_spans", F.array_sort(F.concat("_base", free)))


def spelled(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["order"] + 1), x["start"].cast("string"), x["end"].cast("string")
    )), ",")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row per row of `docs`."""
    found = with_spans(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(spelled(F.col("_base")), 256).alias("base_sha256"),
        spelled(F.col("_spans")).alias("spans"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """`docs` with a mark in place of every secret; touching spans share one mark. Other columns stay.

    A column n_chars, where there is one, follows the text; texts without secrets are not touched.
    """
    found = with_spans(docs.select(F.struct(*docs.columns).alias("_row"), F.col("text")))
    done = F.aggregate(
        "_spans",
        F.expr("named_struct('at', 0L, 'out', '')"),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] < s["at"], s["out"]).otherwise(
                F.concat(s["out"], F.substring("text", (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(MARK))
            ).alias("out"),
        ),
        lambda s: F.concat(s["out"], F.substring("text", (s["at"] + 1).cast("int"), F.length("text"))),
    )
    new = F.when(F.size("_spans") > 0, done).otherwise(F.col("text"))
    out = found.withColumn("_new", new)
    columns = {c: F.col("_row")[c].alias(c) for c in docs.columns}
    columns["text"] = F.col("_new").alias("text")
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.size("_spans") > 0, F.length("_new").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("_row")["n_chars"]
        ).alias("n_chars")
    return out.select(*columns.values())
