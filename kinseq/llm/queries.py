"""The contract queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinseq.llm.common import crc_mod, table


#: op1 lists the units of passages of so many words; shorter repeats are cut all the same.
PASSAGE = 30


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each removed unit of a copied passage: where it was, its words and its passage's, which
    document keeps it, and a digest of what is left of its own document once every repeat is cut.
    Repeats in shorter passages (one sentence met by chance) are cut too, as the digest shows, but not listed."""
    from kinseq.llm.substring_dedup import remove_repeats

    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = out.select("doc_id", F.explode(F.filter("removed", lambda r: r["passage_words"] >= PASSAGE)).alias("r"), F.sha2("text", 256).alias("text_sha256"))
    return rows.select("doc_id", "r.start", "r.end", "r.words", "r.kept_in", "r.passage_words", "text_sha256")


OP1_SQL = r"""
WITH cut AS (
  SELECT doc_id, text, string_split(regexp_replace(text, '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) AS l FROM documents),
unit AS (
  SELECT doc_id, text, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM cut),
placed AS (
  SELECT *, CAST(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) - length(line) - 1 AS s0,
    trim(regexp_replace(lower(line), '[ \t\n\r\f\v]+', ' ', 'g'), ' ') AS norm FROM unit),
counted AS (SELECT *, len(string_split(norm, ' ')) AS words FROM placed),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, pos) AS n, min(doc_id) OVER (PARTITION BY norm) AS lo FROM counted WHERE words >= 3),
broken AS (SELECT *, sum(CASE WHEN n > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM ranked),
span AS (
  SELECT doc_id, run, min(pos) AS p0, max(pos) AS p1, CAST(sum(words) AS BIGINT) AS passage_words
  FROM broken WHERE n > 1 GROUP BY doc_id, run),
kept AS (
  SELECT u.doc_id, string_agg(u.line || substr(u.text, u.s0 + length(u.line) + 1, 1), '' ORDER BY u.pos) AS t
  FROM placed u WHERE NOT EXISTS (SELECT 1 FROM span s WHERE s.doc_id = u.doc_id AND u.pos BETWEEN s.p0 AND s.p1) GROUP BY u.doc_id)
SELECT b.doc_id, b.s0 AS start, b.s0 + length(b.line) AS "end", CAST(b.words AS BIGINT) AS words, b.lo AS kept_in, passage_words, sha256(coalesce(kept.t, '')) AS text_sha256
FROM broken b JOIN span s ON b.doc_id = s.doc_id AND b.run = s.run LEFT JOIN kept ON kept.doc_id = b.doc_id WHERE b.n > 1 AND passage_words >= 30
"""


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinseq.llm.ngram_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D ]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM t),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM sets),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS m, b.n AS n, count(*) AS c FROM flat a JOIN flat b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM pair WHERE 100 * c >= 80 * (m + n - c)),
sides AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach(x, y) AS (SELECT x, y FROM sides UNION SELECT r.x, b.y FROM reach r JOIN sides b ON r.y = b.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id FROM sets LEFT JOIN low ON doc_id = x
"""


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinseq.llm.lm_score import score_texts

    held = F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False))
    out = score_texts(table(spark, sf_dir, "documents"), ~held)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinseq.llm.quality import THRESHOLD, score_quality

    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    out = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinseq.llm.language_id import identify

    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    out = identify(table(spark, sf_dir, "documents"), ~held)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinseq.llm.hilbert_ann import nearest_neighbours

    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinseq.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinseq.llm.template_lines import drop_template_lines

    out = drop_template_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("n_lines").cast("long"), F.size("dropped").cast("long").alias("n_dropped"), F.array_join(F.col("dropped").cast("array<string>"), ";").alias("dropped"), F.sha2("text", 256).alias("text_sha256"))


def op8_sql(documents: str = "documents", grow: int = 3) -> str:
    """WITH-clauses that end in ``dropped(rid, pos)`` and ``line(rid, doc_id, text, pos, line)``."""
    rounds = []
    for k in range(1, grow + 1):
        left = f"forms{k}"
        rounds.append(rf"""
{left} AS (SELECT leaf, form, c FROM forms{k - 1 if k > 1 else ''} {f'ANTI JOIN member{k - 1} USING (leaf, form)' if k > 1 else ''}),
token{k} AS (SELECT leaf, form, c, generate_subscripts(string_split(form, ' '), 1) AS at_, unnest(string_split(form, ' ')) AS token FROM {left}),
vote{k} AS (SELECT leaf, at_, token, sum(c) AS c, sum(sum(c)) OVER (PARTITION BY leaf, at_) AS total FROM token{k} GROUP BY leaf, at_, token),
constant{k} AS (SELECT leaf, at_, token FROM vote{k} WHERE 2 * c > total AND token <> '<*>'),
member{k} AS (
  SELECT leaf, form, {k} AS grown FROM token{k} JOIN constant{k} USING (leaf, at_, token) GROUP BY leaf, form HAVING count(*) >= 0.5 * len(string_split(form, ' '))),""")
    every = " UNION ALL ".join(f"SELECT * FROM member{k}" for k in range(1, grow + 1))
    return rf"""
row_ AS (SELECT row_number() OVER () AS rid, doc_id, text FROM {documents}),
line AS (
  SELECT rid, doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos, unnest(string_split(text, chr(10))) AS line FROM row_),
parsed AS (
  SELECT *, trim(line, ' ') AS bare, string_split(trim(line, ' '), ' ') AS tok FROM line),
seen AS (
  SELECT rid, text, pos, len(tok) || ':' || regexp_replace(array_to_string(tok[1:3], ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS leaf, regexp_replace(bare, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS form,
    count(*) OVER (PARTITION BY rid) AS size FROM parsed WHERE bare <> ''),
wide AS (SELECT leaf FROM seen GROUP BY leaf HAVING count(DISTINCT text) >= 10),
uses AS (SELECT DISTINCT text, leaf, form FROM seen SEMI JOIN wide USING (leaf)),
forms AS (SELECT leaf, form, count(*) AS c FROM uses GROUP BY leaf, form),{"".join(rounds)}
member AS ({every} UNION ALL SELECT leaf, form, 0 FROM forms),
template_ AS (SELECT leaf, grown, CASE WHEN grown = 0 THEN form END AS own_form, text FROM uses JOIN member USING (leaf, form) GROUP BY ALL),
common_ AS (SELECT leaf, grown, own_form FROM template_ GROUP BY ALL HAVING count(*) >= 10),
candidate AS (SELECT DISTINCT m.leaf, m.form FROM member m JOIN common_ c ON m.leaf = c.leaf AND m.grown = c.grown AND (m.grown > 0 OR m.form = c.own_form)),
own AS (SELECT text FROM (SELECT DISTINCT text, pos, leaf, form, size FROM seen) SEMI JOIN candidate USING (leaf, form) GROUP BY text HAVING count(*) <= CAST(2 AS DOUBLE) / 3 * any_value(size)),
recurring AS (
  SELECT leaf, grown, own_form FROM template_ t LEFT JOIN own o ON t.text = o.text GROUP BY ALL HAVING count(o.text) >= 10 AND count(o.text) >= 0.2 * count(*)),
chosen AS (SELECT DISTINCT m.leaf, m.form FROM member m JOIN recurring c ON m.leaf = c.leaf AND m.grown = c.grown AND (m.grown > 0 OR m.form = c.own_form)),
dropped AS (SELECT rid, pos FROM seen SEMI JOIN chosen USING (leaf, form))"""


OP8_SQL = (
    "WITH "
    + op8_sql()
    + r"""
SELECT r.doc_id, CASE WHEN r.text IS NULL THEN 0 ELSE count(l.pos) END AS n_lines, count(d.pos) AS n_dropped,
  coalesce(string_agg(CAST(d.pos AS VARCHAR), ';' ORDER BY d.pos), '') AS dropped,
  CASE WHEN r.text IS NULL THEN NULL ELSE sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (d.pos IS NULL), '')) END AS text_sha256
FROM row_ r LEFT JOIN line l USING (rid) LEFT JOIN dropped d ON l.rid = d.rid AND l.pos = d.pos
GROUP BY r.rid, r.doc_id, r.text
"""
)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinseq.llm.decontaminate import leaks

    out = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", *[F.round(c, 6).alias(c) for c in ("overlap", "question_overlap", "answer_overlap", "score")])


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    """Where the public vocabulary files of this machine are; never copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinseq.llm.sentencepiece_bpe import digests

    return digests(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op8_line_dedup": op8_line_dedup,
    "op10_sentencepiece": op10_sentencepiece,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_language_id": op5_language_id,
    "op9_decontamination": op9_decontamination,
    "op3_lm_scoring": op3_lm_scoring,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_html_extraction": op7_html_extraction,
}
ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op2_ngram_jaccard_join": OP2_SQL,
    "op8_line_dedup": OP8_SQL,
}
