"""Text expressions: composition, numbered lists, ids, names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compose(fields: list[Column], sep: str = " ", strip_prefix: str | None = None) -> Column:
    """Join what is present; null, "" and any "none" are left out. ``strip_prefix`` is a pattern."""
    parts = F.filter(F.array(*[f.cast("string") for f in fields]), lambda x: x.isNotNull() & (x != "") & ~x.isin("none", "None"))
    text = F.array_join(parts, sep)
    return F.trim(F.regexp_replace(text, f"^(?:{strip_prefix})", "") if strip_prefix else text)


def numbered(texts: Column) -> Column:
    """"1) A 2) B": blanks dropped, neighbours that repeat collapsed, a single text unchanged."""
    clean = F.filter(F.transform(texts, lambda x: F.trim(F.coalesce(x, F.lit("")))), lambda x: x != "")
    once = F.filter(clean, lambda x, i: (i == 0) | (x != F.get(clean, i - 1)))
    return F.when(F.size(once) <= 1, F.coalesce(F.get(once, F.lit(0)), F.lit(""))).otherwise(
        F.array_join(F.transform(once, lambda x, i: F.concat((i + 1).cast("string"), F.lit(") "), x)), " ")
    )


def final_text(policy: str, channel: Column, text: Column, context: Column, coarse: str = "coarse", fine: tuple[str, ...] = ("fine",)) -> Column:
    """The text a clip is trained on: its own, or framed by the coarse channel's."""
    if policy != "coarse_fine":
        return text
    framed = F.concat(F.lit("<context: "), F.coalesce(context, F.lit("")), F.lit("> <action: "), text, F.lit(">"))
    return F.when(F.coalesce(text, F.lit("")) == "", text).when(channel.isin(*fine), framed).when(channel == coarse, F.concat(F.lit("<"), text, F.lit(">"))).otherwise(text)


def safe_name(c: Column) -> Column:
    """A file name: "/" becomes "__", ":" becomes "_"."""
    return F.replace(F.replace(c, F.lit("/"), F.lit("__")), F.lit(":"), F.lit("_"))


def dataset_of(ident: Column) -> Column:
    """What stands before the first ":" of an id, else "unknown"."""
    return F.when(ident.contains(":"), F.split_part(ident, F.lit(":"), F.lit(1))).otherwise(F.lit("unknown"))


def url_basename(url: Column) -> Column:
    """The last part of a URL's path."""
    return F.regexp_extract(F.split_part(url, F.lit("?"), F.lit(1)), r"[^/]*$", 0)


def fill_template(template: str, tokens: dict[str, Column]) -> Column:
    """A path template with {names} replaced."""
    out = F.lit(template)
    for name, c in tokens.items():
        out = F.replace(out, F.lit("{" + name + "}"), c)
    return out


def answer(points: Column) -> Column:
    """"t=0.5s: (12, 34); …" of an array of (t, x, y); a point without x is "(no gaze)"."""
    shown = F.transform(points, lambda p: F.concat(F.lit("t="), F.format_string("%.1f", F.bround(p["t"], 1)), F.lit("s: "), F.when(p["x"].isNull(), F.lit("(no gaze)")).otherwise(F.concat(F.lit("("), F.rint(p["x"]).cast("long").cast("string"), F.lit(", "), F.rint(p["y"]).cast("long").cast("string"), F.lit(")")))))
    return F.array_join(shown, "; ")
