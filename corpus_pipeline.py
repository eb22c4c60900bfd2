"""Cleans a corpus for training: language, boilerplate lines, near-duplicates, benchmark leaks, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm import bpe, decontam, langid, linededup, neardup
from spanlake.llm.frames import bound_batches, discard, read, scratch, stored

#: The columns of documents, which all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies are linked from this similarity on, in hundredths: a stage's "0.8 or more", read as op9's 0.85.
NEAR_PERCENT = 85
#: A text goes whose best cosine is below that of this share of the training rows that were labelled and found to be of the
#: language, or below so many standard deviations of an unrelated bundle's cosine (1 / sqrt(DIM)).
LOW_SCORE, NOISE = 0.005, 4
#: Rank error of the quantiles: 1 / ACCURACY of the rows of a language.
ACCURACY = 100_000


def least_scores(scored: DataFrame, lang: str = "lang", found: str = "_predicted", score: str = "_score") -> dict[str, float]:
    """The least score of each language, from scored training rows that are labelled with the language found."""
    right = scored.where(F.col(found) == F.col(lang)).groupBy(F.col(found).alias("l"))
    return {r.l: r.q for r in right.agg(F.percentile_approx(score, LOW_SCORE, ACCURACY).alias("q")).collect()}  # MAX_LANGS rows at most


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters (null and empty ones too) and those like no learned language; fills in null languages.

    What is too unlike comes from the scores of all labelled training rows, by language, and from noise. Languages are learned
    from the labelled rows of the training folds. Without any label nothing is learned; then only texts without letters go. Of
    languages with the same cosine the first by name is found. Repeated rows stay or go together, a null doc_id is no matter,
    and other columns than those of documents aren't returned. No rows: none.
    """
    bound_batches(spark)
    prototypes = langid.fit(docs.where(~langid.held_out()))
    if not prototypes:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    found = langid.predict(docs.select(*COLUMNS), prototypes, out_lang="_predicted", out_score="_score")
    training = docs.where(~langid.held_out() & F.col("lang").isNotNull()).select("text", "lang")
    least = least_scores(langid.predict(training, prototypes, out_lang="_predicted", out_score="_score").drop("text"))
    noise = NOISE / langid.DIM**0.5
    cutoffs = F.create_map(*[F.lit(x) for k in prototypes for x in (k, max(noise, least.get(k, noise)))])
    return found.where((F.col("_predicted") != langid.UNKNOWN) & (F.col("_score") >= cutoffs[F.col("_predicted")])).withColumn("lang", F.coalesce("lang", "_predicted")).select(*COLUMNS)


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that are boilerplate of their source; n_chars is counted anew. All documents stay.

    A null source is one of its own. A null text stays null (n_chars too), an empty one empty; a text of boilerplate lines only
    stays whole. Repeated rows count as pages each and get equal texts. Other columns aren't returned. No rows: none.
    """
    bound_batches(spark)
    return linededup.drop_boilerplate(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each group of near copies, and one of the rows that share its doc_id and text.

    Rows of one doc_id with different texts all stay, as do rows without a doc_id: nothing says that they are copies.
    """
    bound_batches(spark)
    kept = neardup.near_duplicates(docs, NEAR_PERCENT).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    once = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang")
    named = docs.select(*COLUMNS).join(kept, "doc_id", "left_semi").withColumn("_row", F.row_number().over(once)).where("_row = 1").drop("_row")
    return named.unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item.

    Null and empty texts hold none and stay, as do all documents where the benchmark has no rows or no words. Repeated rows and
    rows of one doc_id are judged by their own texts. Other columns aren't returned. No rows: none.
    """
    return decontam.contaminated(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark")).where("NOT contaminated").select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, the token ids, their number and hash, and the hash of the bytes they decode to.

    A null or empty text has no ids and the hashes of nothing. Rows stay as they are, repeated ones and those without a doc_id
    too; other columns aren't returned. No rows: none.
    """
    import public_tokenizers

    bound_batches(spark)
    out = bpe.round_trip(docs.select(*COLUMNS), public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN, keep_ids=True)
    return out.select("doc_id", "lang", "source", "n_chars", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_boilerplate),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_leaks),
    ("byte_bpe", tokenize),
]
#: Language profiles, sketches and byte-pair merges are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written to the checkpoint folder before the next reads it, and deleted when that has."""
    docs = before = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            after = keep(stored(stage(spark, before, sf_dir)))
        if before is not docs:
            discard(before)
        before = after
    return STAGES[-1][1](spark, before, sf_dir)
