"""The registered queries of these operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.llm import alignment, bpe, hard_negatives, language_id, line_dedup, mixing, ngram_join, nn_descent, pii, quality, simhash, token_counts, url_filter
from adstrata.llm.common import read
from adstrata.llm.tokenizer import Vocabulary

Query = Callable[[SparkSession, str], DataFrame]

_registered: dict[str, Query] = {}


def query(function: Query) -> Query:
    _registered[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_registered)


def vocabulary(spark: SparkSession) -> Vocabulary:
    return Vocabulary(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def _digest(column: str) -> F.Column:
    return F.lower(F.sha2(column, 256))


@query
def op1_byte_level_bpe(spark, sf_dir):
    """Every text encoded and decoded again."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(documents, vocabulary(spark)), vocabulary(spark))
    return coded.select("doc_id", "n_tokens", _digest("ids").alias("ids_sha256"), _digest("decoded").alias("decoded_sha256"))


@query
def op2_personal_data(spark, sf_dir):
    """Every document's personal data: by fixed patterns, and by contexts learned from those."""
    found = pii.find(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", _digest("base").alias("base_sha256"), "spans")


@query
def op3_quality_rules(spark, sf_dir):
    """Every document's measures, and whether it is within the fences of its language and source."""
    judged = quality.judged(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op4_line_dedup(spark, sf_dir):
    """Every document's lines that nearly repeat an earlier one, and what is left of its text."""
    left = line_dedup.without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        "doc_id",
        "n_lines",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
        _digest("text").alias("text_sha256"),
    )


@query
def op5_approximate_neighbours(spark, sf_dir):
    """The five nearest vectors of every fiftieth one."""
    return nn_descent.nearest(read(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


@query
def op6_source_mixing(spark, sf_dir):
    """What the mix takes of every document."""
    times = mixing.repetitions(read(spark, sf_dir, "documents"))
    return times.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


@query
def op7_ngram_jaccard_join(spark, sf_dir):
    """Classes of documents whose sets of 5-word shingles are at least 0.8 similar."""
    found = ngram_join.similar_documents(read(spark, sf_dir, "documents"), words=5, percent=80)
    return found.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id")


#: Verdict, host and path of the registered filter.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Host names that put a page's URL on the list of the registered filter.
LISTED_HOSTS = r"(^|[.-])(casino|bets|pills)([.-]|$)"


@query
def op8_url_filter(spark, sf_dir):
    """Every page judged by the rules, or by the list of canonical URLs of pages on bad hosts."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    host, _ = url_filter.host_and_path(F.col("url"))
    listed = pages.filter(host.rlike(LISTED_HOSTS)).select(url_filter.canonical(F.col("url")).alias("canonical")).distinct()
    return url_filter.judged(pages, listed, URL_RULES)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether a document belongs to the fold that language ID doesn't learn from. One without an id isn't."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


@query
def op9_language_id(spark, sf_dir):
    """The language of every text, by a model of those that aren't held out."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learnt = documents.filter(~held_out() & F.col("doc_id").isNotNull())
    found = language_id.predict(documents.select("doc_id", "text"), language_id.train(learnt))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def edits_of(documents: DataFrame) -> DataFrame:
    """`documents` with three edits each, placed by a hash: words taken out, words put in, and the end rewritten."""
    size = F.coalesce(F.length("text"), F.lit(0))
    place = lambda n: F.pmod(F.xxhash64("doc_id", F.lit(n)), size + 1).cast("int")
    taken, put = place(1), place(2)
    edits = F.array(
        F.struct(taken.alias("start"), (taken + 40).alias("stop"), F.lit("").alias("new")),
        F.struct(put.alias("start"), put.alias("stop"), F.concat(F.lit(" edit "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" ")).alias("new")),
        F.struct(F.greatest(size - 80, F.lit(0)).alias("start"), size.alias("stop"), F.lit(" the end.\n").alias("new")),
    )
    return documents.withColumn("edits", edits.cast(token_counts.EDITS))


@query
def op10_token_counts(spark, sf_dir):
    """Every document's tokens before and after three edits."""
    documents = edits_of(read(spark, sf_dir, "documents").select("doc_id", "text"))
    trees = token_counts.count_trees(documents, vocabulary(spark)).withColumn("n_before", F.col("n_tokens"))
    after = token_counts.apply_edits(trees, vocabulary(spark))
    return after.select("doc_id", "n_before", F.col("n_tokens").alias("n_after"), "n_encoded", F.size("tree.chars").cast("long").alias("n_leaves"))


@query
def op11_hard_negatives(spark, sf_dir):
    """Negatives nearly as near as the positives of every hundredth vector, a seventh of the labels being changed before."""
    embeddings = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.vectors_of(embeddings.withColumn("label", changed))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


@query
def op12_simhash_near_duplicates(spark, sf_dir):
    """Every document's fingerprint, and its class of documents linked by near fingerprints."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def tokenizers(spark: SparkSession) -> alignment.Tokenizers:
    path = public_tokenizers.path
    return alignment.Tokenizers(spark, path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))


@query
def op13_tokenizer_alignment(spark, sf_dir):
    """Every text's tokens of two tokenizers, the groups in which they align, and how common its links are."""
    return alignment.aligned(read(spark, sf_dir, "documents"), tokenizers(spark))
