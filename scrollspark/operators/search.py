"""Full-text index: terms of texts, and queries that ask for all of some terms.

Terms are runs of letters and digits of any script, lower-cased, without English stop
words, reduced by the S-stemmer (Harman 1991), which undoes English plurals only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The stop words of the usual English text search configuration.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs "
    "themselves what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if or because "
    "as until while of at by for with about against between into through during before after above below to from up down in out on off over under again further "
    "then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t can will just don should now"
).split()
SEPARATORS = r"[^\p{L}\p{N}]+"
#: What a plural looks like, what is taken from its end, and what is put there; the first that fits counts.
PLURALS = (("[^ea]ies$", "ies$", "y"), ("[^aeo]es$", "s$", ""), ("[^us]s$", "s$", ""))


def stem(term: Column) -> Column:
    rules = [(term.rlike(like), F.regexp_replace(term, cut, put)) for like, cut, put in PLURALS]
    return reduce(lambda found, rule: found.when(*rule), rules[1:], F.when(*rules[0])).otherwise(term)


def index(texts: DataFrame, key: str, columns: str | Sequence[str] = "text", stops: Sequence[str] = STOP_WORDS, stemmed: bool = True) -> DataFrame:
    """term, key, tf: how often each term is in the columns of each text; null columns count as empty."""
    columns = [columns] if isinstance(columns, str) else columns
    words = F.split(F.lower(F.concat_ws(" ", *columns)), SEPARATORS)
    terms = texts.select(key, F.explode(words).alias("term")).where((F.col("term") != "") & ~F.col("term").isin(list(stops)))
    return terms.groupBy((stem(F.col("term")) if stemmed else F.col("term")).alias("term"), key).agg(F.count(F.lit(1)).alias("tf"))


def search(inverted: DataFrame, key: str, terms: Sequence[str], stops: Sequence[str] = STOP_WORDS, stemmed: bool = True) -> DataFrame:
    """Keys that have all terms; stop words are not asked for.  The filter on terms comes before any grouping."""
    wanted = sorted({t.lower() for t in terms} - set(stops))
    literals = F.array_distinct(F.array(*(stem(F.lit(t)) if stemmed else F.lit(t) for t in wanted)))
    hits = inverted.where(F.array_contains(literals, F.col("term"))).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return hits.where(F.col("_n") == F.size(literals)).select(key)
