"""Chat formatting with a grammar that can be read back, in native functions alone.

    conversation := turn*
    turn         := "### " name [" (escaped)"] ": " body " </turn>\n"

A role of small letters is named with a capital, any other as `=` and its URL
encoding.  A body holds no control string unless its turn is escaped; there each
one has a backslash in front, which reading takes away again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = "(###|</turn>)"
ESCAPED = r"\\(###|</turn>)"
END = " </turn>\n"
HEADER = r"(?s)^### ([A-Z][a-z]*|=[^ :]*)( \(escaped\))?: (.*)$"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescape(body: Column) -> Column:
    return F.regexp_replace(body, ESCAPED, "$1")


def header(role: Column, escaped: Column) -> Column:
    plain = role.rlike("^[a-z]+$")
    name = F.when(plain, F.initcap(role)).otherwise(F.concat(F.lit("="), F.url_encode(role)))
    return F.concat(F.lit("### "), name, F.when(escaped, " (escaped)").otherwise(""), F.lit(": "))


def render(role: Column, text: Column, escaped: Column) -> Column:
    body = F.when(escaped, escape(text)).otherwise(text)
    return F.concat(header(role, escaped), body, F.lit(END))


def read(formatted: Column) -> Column:
    """The turns of a formatted text as structs of role and text.

    A stretch that is no turn of the grammar has a null role and text.
    """

    def turn(part: Column) -> Column:
        name, body = F.regexp_extract(part, HEADER, 1), F.regexp_extract(part, HEADER, 3)
        escaped = F.regexp_extract(part, HEADER, 2) != ""
        # What is left without the escaped control strings must hold none.
        rest = F.when(escaped, F.regexp_replace(body, ESCAPED, "")).otherwise(body)
        valid = part.rlike(HEADER) & ~rest.rlike(CONTROL)
        role = F.when(name.startswith("="), F.try_url_decode(F.substring(name, 2, 1 << 30))).otherwise(F.lower(name))
        text = F.when(escaped, unescape(body)).otherwise(body)
        return F.struct(F.when(valid, role).alias("role"), F.when(valid, text).alias("text"))

    parts = F.split(formatted, END)
    # Behind the last end there is an empty part, or a turn that has no end.
    whole = F.filter(parts, lambda part, i: (i < F.size(parts) - 1) | (part != ""))
    return F.transform(whole, turn)


def format(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its id, `formatted`, `loss`, `n_escaped` and `round_trip`.

    Turns go by number, those of the same number by role and text; a null number
    comes first, a null role or text is empty, repeated rows are repeated turns,
    and rows without a conversation id are one conversation.  Each turn is
    rendered as it is and read back; where that gives another turn, or none, it
    is rendered escaped.  `loss` has one struct per turn, the start in the turn's
    rendering and length of what a loss is taken on, the body of assistant turns
    (length 0 for others).  `round_trip` tells whether reading the whole text
    gives the turns of the source.  A conversation is one value, as its text is;
    nothing else is gathered.  An empty table gives an empty one; other columns
    are left out.
    """
    said = turns.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("said"),
    )
    talks = said.groupBy("conv").agg(F.sort_array(F.collect_list("said")).alias("said"))

    def conflicts(t: Column) -> Column:
        back = read(render(t["role"], t["text"], F.lit(False)))
        return ~back.eqNullSafe(F.array(F.struct(t["role"].alias("role"), t["text"].alias("text"))))

    checked = talks.select(
        "conv",
        F.transform(
            "said", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), conflicts(t).alias("escaped"))
        ).alias("said"),
    )
    drawn = checked.select(
        "conv",
        "said",
        F.array_join(F.transform("said", lambda t: render(t["role"], t["text"], t["escaped"])), "").alias("formatted"),
    )

    def mask(t: Column) -> Column:
        body = F.when(t["escaped"], escape(t["text"])).otherwise(t["text"])
        return F.struct(
            F.length(header(t["role"], t["escaped"])).alias("start"),
            F.when(t["role"] == LOSS_ROLE, F.length(body)).otherwise(0).alias("length"),
        )

    source = F.transform("said", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return drawn.select(
        F.col("conv").alias(conv),
        "formatted",
        F.transform("said", mask).alias("loss"),
        F.size(F.filter("said", lambda t: t["escaped"])).alias("n_escaped"),
        read(F.col("formatted")).eqNullSafe(source).alias("round_trip"),
    )


def loss_text(formatted: str = "formatted", loss: str = "loss") -> Column:
    """The text under the loss mask, unescaped, turn after turn.

    A turn that is not escaped holds no control string, so there is nothing to take away.
    """
    under = F.zip_with(
        F.split(F.col(formatted), END),
        F.col(loss),
        lambda part, m: unescape(F.substring(part, m["start"] + 1, F.coalesce(m["length"], F.lit(0)))),
    )
    return F.array_join(under, "")


def digest(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Counts and SHA-256 of what formatted texts give when they are read back."""
    back = formatted.select(
        conv, "formatted", "round_trip", read(F.col("formatted")).alias("turns"), loss_text().alias("under")
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        conv,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("under").cast("long").alias("loss_chars"),
        F.sha2("under", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    )
