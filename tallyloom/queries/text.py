"""Word counts over whole document texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text as tx
from tallyloom.operators import aggregates, heavy, ranking
from tallyloom.queries.registry import query
from tallyloom.sources.readers import Tables

STOP_SQL = ", ".join(f"'{w}'" for w in tx.STOP_WORDS)


@query(r"""WITH words AS (SELECT unnest(string_split_regex(lower(text), '[ \t\n\x0B\f\r]+')) AS word FROM documents)
SELECT word, CAST(count(*) AS BIGINT) AS n FROM words WHERE length(word) >= 3 GROUP BY word""")
def word_count(t: Tables) -> DataFrame:
    return aggregates.count_by(aggregates.word_rows(t.documents, tx.words(F.col("text")), min_length=3), ["word"])


@query(f"""WITH words AS (SELECT unnest(string_split_regex(lower(text), '[^a-z0-9_]+')) AS word FROM documents)
SELECT word, CAST(count(*) AS BIGINT) AS n FROM words WHERE word <> '' AND word NOT IN ({STOP_SQL})
GROUP BY word ORDER BY n DESC, word LIMIT 20""")
def title_word_freq(t: Tables) -> DataFrame:
    kept = aggregates.word_rows(t.documents, tx.plain_words(F.col("text")), drop=tx.STOP_WORDS)
    return ranking.top_k(aggregates.count_by(kept, ["word"]), [F.desc("n"), F.col("word")], 20)


@query(f"""WITH words AS (SELECT unnest(string_split_regex(lower(text), '[^a-z0-9_]+')) AS word FROM documents)
SELECT word, CAST(count(*) AS BIGINT) AS n, true AS proven FROM words WHERE word <> '' AND word NOT IN ({STOP_SQL})
GROUP BY word ORDER BY n DESC, word LIMIT 20""")
def heavy_words(t: Tables) -> DataFrame:
    """As ``title_word_freq``, without a row per distinct word in any shuffle."""
    kept = aggregates.word_rows(t.documents, tx.plain_words(F.col("text")), drop=tx.STOP_WORDS)
    return heavy.heavy_values(kept, "word", 20)
