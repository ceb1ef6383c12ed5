"""Queries of the training-data operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score, train

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs.where(~held_out()), labels.where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .templates import main_text

    return main_text(table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import compare_with_next

    return compare_with_next(table(spark, sf_dir, "documents"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import place, plan

    docs = table(spark, sf_dir, "documents")
    return place(docs, plan(docs))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import encode

    return encode(table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify, train

    docs = table(spark, sf_dir, "documents")
    parser = train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return identify(docs, parser).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .similarity import similar_texts

    return similar_texts(table(spark, sf_dir, "documents")).drop("text_hash")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import apply_rules

    return apply_rules(table(spark, sf_dir, "documents"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .factorisation import score, train

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs.where(~held_out()), labels.where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .negatives import hard_negatives

    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", noisy))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_main_text, op3_token_counts, op4_fingerprints, op5_repeats, op6_mixing, op7_sentencepiece, op8_language, op9_jaccard_join, op10_quality, op11_quality_classifier, op12_collocations, op13_hard_negatives)}

#: DuckDB SQL where SQL can express the operator; the others are tested against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op12_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
word_lists as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, 1 as size, unnest(w) as phrase from word_lists
  union all select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from word_lists
  union all select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from word_lists),
counted as (select lang, size, phrase, count(*) as f from grams group by all),
totals as (select lang, sum(f) as n from counted where size = 1 group by lang),
candidates as (select lang, size, phrase, f as a, string_split(phrase, ' ') as w from counted where size > 1 and f >= 10),
cuts as (
  select lang, size, phrase, a, 1 as k, w[1] as lhs, array_to_string(w[2:], ' ') as rhs from candidates
  union all select lang, size, phrase, a, 2, w[1] || ' ' || w[2], w[3] from candidates where size = 3),
cut_scores as (
  select c.lang, c.size, c.phrase, c.a, k, x.f as l, y.f as r, (1000000::hugeint * a * a) // (x.f::hugeint * y.f) as score
  from cuts c join counted x on x.lang = c.lang and x.phrase = c.lhs join counted y on y.lang = c.lang and y.phrase = c.rhs),
best as (select * from cut_scores qualify row_number() over (partition by lang, phrase order by score, k) = 1),
around as (
  select lang, w[1] || ' ' || w[2] as phrase, a from candidates where size = 3
  union all select lang, w[2] || ' ' || w[3], a from candidates where size = 3),
kept as (select b.* from best b where not exists (select 1 from around o where o.lang = b.lang and o.phrase = b.phrase and 100 * o.a >= 50 * b.a)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select ranked.lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join totals on totals.lang = ranked.lang where rank <= 2000
""",
    "op13_hard_negatives": """
with e as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
    cast(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) as bigint) as score
  from e a join e b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as int) as rank, id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, id) <= 10
""",
}
