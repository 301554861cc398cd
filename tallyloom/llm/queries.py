"""The registered queries of the operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import oracles
from tallyloom.llm.alignment import Tokenizers, aligned_tokens
from tallyloom.llm.common import read_table
from tallyloom.llm.decontaminate import matches
from tallyloom.llm.embeddings import PigeonholeJoin, near_vectors
from tallyloom.llm.fuzzy_lines import ALL_LINES, without_duplicate_lines
from tallyloom.llm.minhash import NearDuplicates, near_duplicates
from tallyloom.llm.packing import Packing, pack
from tallyloom.llm.quotations import reply_threads
from tallyloom.llm.secret_scan import KINDS, find_secrets, joined, of_kind
from tallyloom.llm.token_counts import TokenCounts, token_counts
from tallyloom.llm.token_files import TokenFiles, read_token_files, write_token_files
from tallyloom.llm.toxicity import score, train
from tallyloom.llm.url_lists import host_of, judged, segments_of
from tallyloom.llm.variants import variants
from tallyloom.plans.durable import scratch_path

Run = Callable[[SparkSession, str], DataFrame]


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), NearDuplicates(words=4, percent=80))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """A tokenizer file of the queries."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"), PigeonholeJoin(cosine=0.9))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    base = KINDS[:3]
    return find_secrets(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(F.size(of_kind(spans, k)).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(joined(of_kind(spans, *base)), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), path, TokenFiles(vocabulary(), end_id=1))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_duplicate_lines(read_table(spark, sf_dir, "documents"), ALL_LINES).select(
        "doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_cut").alias("n_cut")
    )


def list_events(pages: DataFrame) -> DataFrame:
    """A dated list derived from the pages: a quarter of the sites and of their sections, by hash, come on it,
    half of these go off again and a part of those comes back."""
    site = F.regexp_replace(host_of(F.col("url")), "^(?:www|m|blog)\\.", "")
    section = F.concat(host_of(F.col("url")), F.lit("/"), segments_of(F.col("url")).getItem(0))
    entries = pages.select(F.explode(F.array(site, F.when(F.size(segments_of(F.col("url"))) > 0, section))).alias("entry"))
    entries = entries.where("entry <> ''").distinct().withColumn("mark", F.md5(F.col("entry").cast("binary")))

    def part(start: int, length: int):
        return F.conv(F.substring("mark", start, length), 16, 10).cast("int")

    first = F.date_add(F.lit("2024-01-01").cast("date"), part(3, 2))
    gone, back = F.date_add(first, 1 + part(6, 2)), F.date_add(first, 31 + part(6, 2))
    moves = F.array(
        F.struct(F.lit("add").alias("action"), first.alias("day")),
        F.when(part(5, 1) < 8, F.struct(F.lit("remove").alias("action"), gone.alias("day"))),
        F.when((part(5, 1) < 8) & (part(8, 1) < 6), F.struct(F.lit("add").alias("action"), back.alias("day"))),
    )
    return entries.where(part(1, 2) < 64).select("entry", F.explode(moves).alias("m")).where("m IS NOT NULL").select("entry", "m.*")


def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 366).cast("int"))
    return judged(pages.select("page_id", "url", day.alias("fetched")), list_events(pages))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, train(docs, read_table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted")


def mails(conversations: DataFrame) -> DataFrame:
    """The turns as mails that quote the two turns before them, nested, as mail programs do."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    turns = conversations
    for k in (1, 2):
        turns = turns.withColumn(f"text{k}", F.lag("text", k).over(order)).withColumn(f"role{k}", F.lag("role", k).over(order))

    def quoted(text: str, signs: str):
        return F.concat(F.lit(signs), F.regexp_replace(text, "\n", f"\n{signs}"))

    body = F.concat_ws(
        "\n",
        F.when(F.col("text1").isNotNull(), F.concat(F.lit("On Monday "), F.coalesce("role1", F.lit("someone")), F.lit(" wrote:"))),
        F.when(F.col("text2").isNotNull(), F.concat(F.lit("> On Sunday "), F.coalesce("role2", F.lit("someone")), F.lit(" wrote:"))),
        quoted("text2", ">> "), quoted("text1", "> "), F.when(F.col("text1").isNotNull(), F.lit("")), "text",
    )
    return turns.select((F.col("conv_id") * 1_000_000 + F.col("turn")).alias("msg_id"), F.col("conv_id").alias("scope"), body.alias("text"))


def op9_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_threads(mails(read_table(spark, sf_dir, "conversations")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), Packing(vocabulary(), end_id=2, capacity=4096))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(read_table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), TokenCounts(vocabulary("piece_bpe_32k.model"), limit=4096))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = Tokenizers(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return aligned_tokens(read_table(spark, sf_dir, "documents"), spec)


QUERIES: dict[str, Run] = {
    f.__name__: f
    for f in (
        op1_minhash_dedup, op2_embedding_dedup, op3_secret_scan, op4_token_files, op5_line_dedup, op6_url_lists,
        op7_decontaminate, op8_toxicity, op9_quotations, op10_packing, op11_spelling_variants,
        op12_token_counts, op13_token_alignment,
    )
}
SQL: dict[str, str] = {
    "op1_minhash_dedup": oracles.MINHASH, "op6_url_lists": oracles.URL_LISTS, "op9_quotations": oracles.QUOTATIONS,
    "op11_spelling_variants": oracles.VARIANTS,
}
