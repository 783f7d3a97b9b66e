"""Region verdicts: prompts over numbered spans, tolerant parsing of answers, region maps."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prompts(spans: DataFrame, keys: list[str], rubric: str, size: int = 60) -> DataFrame:
    """(keys, chunk, prompt): spans with an index ``i``, ``size`` of them per prompt."""
    line = F.concat_ws(" ", F.concat(F.lit("["), F.col("i").cast("string"), F.lit("]")), F.format_string("%.1f-%.1f", F.bround("start_s", 1), F.bround("end_s", 1)), F.col("channel"), F.col("text"))
    g = spans.withColumn("chunk", F.floor(F.col("i") / F.lit(size)).cast("long")).groupBy(*keys, "chunk").agg(F.sort_array(F.collect_list(F.struct("i", line.alias("line")))).alias("lines"))
    return g.select(*keys, "chunk", F.concat(F.lit(rubric + "\n"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n")).alias("prompt"))


def prompts_again(spans: DataFrame, found: DataFrame, keys: list[str], rubric: str, size: int = 60) -> DataFrame:
    """Prompts for spans whose chunk's answer was cut off before them: of half the size, numbered as before."""
    left = spans.join(found.select(*keys, "i").distinct(), [*keys, "i"], "left_anti")
    return prompts(left, keys, rubric, max(size // 2, 1))


def salvage(text: str | None) -> list[dict]:
    """The objects of the first JSON array in a text; of a cut-off array those that are complete."""
    if not text:
        return []
    at = text.find("[")
    if at < 0:
        return []
    decoder = json.JSONDecoder()
    try:
        v, _ = decoder.raw_decode(text, at)
        return [x for x in v if isinstance(x, dict)]
    except ValueError:
        pass
    out, i = [], at + 1
    while (i := text.find("{", i)) >= 0:
        try:
            v, i = decoder.raw_decode(text, i)
        except ValueError:
            i += 1
            continue
        if isinstance(v, dict):
            out.append(v)
    return out


def verdicts(answers: DataFrame, keys: list[str], column: str = "answer") -> DataFrame:
    """(keys, i, interesting, reason) from free-text answers, in Arrow batches; of one span the last counts."""
    kinds = dict(answers.dtypes)

    def parse(it):
        import pandas as pd

        for pdf in it:
            rows = []
            for r in pdf.itertuples(index=False):
                *k, text = r
                for v in salvage(text):
                    i = v.get("i", v.get("index"))
                    if isinstance(i, (int, float)) and not isinstance(i, bool):
                        rows.append((*k, int(i), v.get("interesting") is True, str(v.get("reason") or "")))
            yield pd.DataFrame(rows, columns=[*keys, "i", "interesting", "reason"])

    return answers.select(*keys, column).mapInPandas(parse, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", i long, interesting boolean, reason string")


def region_map(spans: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Spans with their verdict; without one they are not interesting. Spans without bounds are dropped."""
    one = found.groupBy(*keys, "i").agg(F.max_by(F.struct("interesting", "reason"), F.struct("interesting", "reason")).alias("v"))
    j = spans.filter("start_s IS NOT NULL AND end_s IS NOT NULL").join(one, [*keys, "i"], "left")
    return j.select(*keys, "i", "start_s", "end_s", "channel", F.coalesce("v.interesting", F.lit(False)).alias("interesting"), F.coalesce("v.reason", F.lit("unlabeled")).alias("reason"))
