"""Split a description into its sections.

Everything happens inside the row with array functions, so a text of any
length needs neither a shuffle nor a window. Both modes rest on one remark:
a section is made of whole runs of lines, so only the positions of header
lines are needed and the runs come out of ``slice``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake import fixed_values as fixed
from vacancylake.functions.text import strip

Keywords = Mapping[str, Sequence[str]]


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda line: line != "")


def _header_rank(line: Column, keywords: Keywords, suffix: str, longest_first: bool) -> Column:
    """Index of the section a header line opens; NULL for other lines."""
    ranked = [(word, rank) for rank, words in enumerate(keywords.values()) for word in words]
    if longest_first:
        ranked.sort(key=lambda pair: -len(pair[0]))
    rank_of = None
    for word, rank in ranked:
        hit = F.contains(line, F.lit(word))
        rank_of = F.when(hit, F.lit(rank)) if rank_of is None else rank_of.when(hit, F.lit(rank))
    return F.when(F.endswith(line, F.lit(suffix)), rank_of)


def _ranked_up_to(limit: int):
    return lambda rank: F.coalesce(rank <= limit, F.lit(False))


def _of_rank(wanted: int):
    return lambda block: block["rank"] == wanted


def split_sections(
    df: DataFrame,
    text: str,
    mode: str = "last",
    keywords: Keywords = fixed.SECTION_KEYWORDS,
    suffix: str = ":",
) -> DataFrame:
    """Add one text column per section.

    ``mode="last"``: a line belongs to the latest header above it.
    ``mode="earliest"``: the section can only move to one of higher precedence,
    so a line belongs to the highest-ranked header seen so far.
    Lines that are exactly ``keyword + suffix`` are not part of the text.
    """
    if mode not in ("last", "earliest"):
        raise ValueError(mode)
    names = list(keywords)
    exact = [word + suffix for words in keywords.values() for word in words]
    longest_first = mode == "last"
    out = df.withColumn("_lines", _lines(F.col(text))).withColumn(
        "_rank", F.transform("_lines", lambda line: _header_rank(line, keywords, suffix, longest_first))
    )
    lines, rank = F.col("_lines"), F.col("_rank")
    past_end = F.size(lines) + 1

    if mode == "earliest":
        # first line whose header ranks k or better; ranks below k start no later
        starts = [
            F.array_position(F.transform(rank, _ranked_up_to(k)), True).cast("int") for k in range(len(names))
        ]
        out = out.withColumns({f"_start{k}": F.when(s > 0, s).otherwise(past_end) for k, s in enumerate(starts)})
        ends = [past_end] + [F.col(f"_start{k}") for k in range(len(names) - 1)]
        runs = [F.slice(lines, F.col(f"_start{k}"), ends[k] - F.col(f"_start{k}")) for k in range(len(names))]
    else:
        heads = F.filter(
            F.transform(rank, lambda r, i: F.struct((i + 1).alias("at"), r.alias("rank"))),
            lambda head: head["rank"].isNotNull(),
        )
        out = out.withColumn("_heads", heads)
        heads = F.col("_heads")
        blocks = F.transform(
            heads,
            lambda head, j: F.struct(
                head["rank"].alias("rank"),
                F.slice(lines, head["at"], F.coalesce(F.get(heads, j + 1)["at"], past_end) - head["at"]).alias("lines"),
            ),
        )
        out = out.withColumn("_blocks", blocks)
        runs = [
            F.flatten(F.transform(F.filter("_blocks", _of_rank(k)), lambda block: block["lines"]))
            for k in range(len(names))
        ]
    kept = {
        name: F.coalesce(F.array_join(F.filter(run, lambda line: ~line.isin(exact)), "\n"), F.lit(""))
        for name, run in zip(names, runs)
    }
    return out.select(*[F.col(c) for c in df.columns], *[value.alias(name) for name, value in kept.items()])


def section_items(text: Column) -> Column:
    """The lines of one section as a list, for the child tables."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda line: line != "")
