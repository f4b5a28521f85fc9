"""Products by name for a table of patterns, through postings of three-letter pieces.

A pattern's plain stretches must stand in every name it matches. Their pieces of three
letters are looked up in the postings, and the pattern itself is only tried on names that
hold all of them. Patterns without such a piece are tried on every name, in blocks.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.session import read_stored

#: Patterns without a piece that one scan of the names tries.
BLOCK = 256


def required_pieces(pattern: str) -> list[str]:
    """Pieces of three characters that every match contains; none if that is not plain.

    Only what stands outside of groups, classes and alternatives counts, and no character
    that a ``?``, ``*`` or ``{`` behind it may leave out.
    """
    if re.search(r"[|(]", pattern):
        return []
    plain = re.sub(r"\\[^\w\s]", lambda m: chr(0xE000 + ord(m[0][1])), pattern)  # escaped marks
    plain = re.sub(r"\\.|\[\^?\]?[^\]]*\]", "\0", plain)  # classes
    plain = re.sub(r"[^\0](?:[?*]|\{[^}]*\})[?+]?", "\0", plain)  # what may be left out or repeat
    plain = re.sub(r"\+[?+]?", "\0", plain)  # what comes before stands at least once
    runs = re.split(r"[\0.^$?*{}]+", plain)
    out = set()
    for run in runs:
        run = "".join(chr(ord(c) - 0xE000) if 0xE000 <= ord(c) < 0xE080 else c for c in run)
        out |= {run[i : i + 3] for i in range(len(run) - 2)}
    return sorted(out)


def pieces(name: Column) -> Column:
    """Distinct pieces of three characters of a name."""
    n = F.length(name)
    starts = F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(name, i, F.lit(3))))


def name_postings(products: DataFrame) -> DataFrame:
    """``piece, product_id, name``, one row per distinct piece of a name."""
    return products.select(F.explode(pieces(F.col("name"))).alias("piece"), "product_id", "name")


def search_names(products: DataFrame, requests: DataFrame, postings: DataFrame | None = None) -> DataFrame:
    """``query, product_id`` for requests ``query, pattern``: names with a match.

    ``postings`` of the same products may be given, stored; else they are made. Equal
    patterns are tried once. Null patterns and names match nothing; a pattern that is no
    regular expression ends the query with its error.
    """
    asked = requests.select("query", "pattern").where("pattern IS NOT NULL").distinct()
    wanted = F.udf(required_pieces, "array<string>")
    patterns = asked.select("pattern").distinct().withColumn("pieces", wanted("pattern"))
    patterns = read_stored(patterns, "patterns")
    known = patterns.where("size(pieces) > 0")
    if postings is None:
        postings = name_postings(products)
    # The rarest piece finds the names; the pattern judges the rest.
    needed = known.select("pattern", F.explode("pieces").alias("piece"))
    counts = postings.join(needed.select("piece").distinct(), "piece", "left_semi")
    counts = counts.groupBy("piece").agg(F.count("*").alias("n"))
    rarest = needed.join(counts, "piece", "left").groupBy("pattern").agg(
        F.min_by("piece", F.coalesce("n", F.lit(0))).alias("piece")
    )
    met = postings.join(rarest.join(known, "pattern"), "piece")
    holds = F.forall("pieces", lambda x: F.contains(F.col("name"), x))
    found = met.where(holds).where(F.expr("name RLIKE pattern")).select("pattern", "product_id")
    for block in _blocks(patterns.where("size(pieces) = 0")):
        hits = F.filter(F.lit(block), lambda p: F.regexp(F.col("name"), p))
        found = found.union(products.select(F.explode(hits).alias("pattern"), "product_id"))
    return asked.join(found, "pattern").select("query", "product_id")


def _blocks(patterns: DataFrame):
    """Patterns without a piece, ``BLOCK`` to a list."""
    rows = patterns.select("pattern").orderBy("pattern").toLocalIterator()
    block: list[str] = []
    for r in rows:
        block.append(r["pattern"])
        if len(block) == BLOCK:
            yield block
            block = []
    if block:
        yield block
