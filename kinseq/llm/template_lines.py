"""Line dedup by a log-template tree, in DataFrame functions only.

A fixed-depth tree parses each line: its number of tokens, then its ``DEPTH`` leading tokens
(tokens that hold a digit are a variable field ``<*>``).  Inside a leaf two kinds of template are
grown: every line with its digit fields masked; and, by similarity, templates that keep a token
where most of the leaf's lines agree and have ``<*>`` elsewhere.  A line belongs to such a template if
it equals at least ``SIMILAR`` of all its places; from the lines that belong to none yet the next
template of the leaf is grown, and so on until nothing is left that could recur: a leaf is done when it
grew none, as its votes then stay as they are, or when what is left of it stands in fewer than
``MIN_DOCS`` texts.

A template *recurs* if it stands in at least ``MIN_DOCS`` different texts, and it is then dropped
from all documents.  The lines of a text and its many copies would recur too, but nearly all of
them; so a text more than ``OWN`` of whose lines stand in as many texts is taken for a copy and does not
count, and a template needs ``MIN_DOCS`` texts, and ``SHARE`` of all that hold it, that are none.  Copies
are thus left to the near-duplicate operator, but lose the lines that recur elsewhere.

Defined results: every input row is returned once; null text stays null with zero lines; blank
lines are never templates; a text all of whose lines go becomes empty; repeated rows (same id and
text) count as one text and all lose the same lines; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinseq.llm.common import materialise, temporary_tables

DEPTH, MIN_DOCS, SIMILAR, OWN, SHARE = 3, 10, 0.5, 2 / 3, 0.2
#: Up to so many recurring leaves the filter on leaves may be broadcast; above, it shuffles.
BROADCAST_LEAVES = 200_000
_FIELD = "[^ ]*[0-9][^ ]*"


def _tokens(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _leaf(line: Column, depth: int) -> Column:
    """The leaf's key, 0 for blank lines."""
    bare = F.trim(line)
    lead = F.regexp_replace(F.substring_index(bare, " ", depth), _FIELD, "<*>")
    return F.when(F.length(bare) == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(_tokens(bare), lead))


def _lines(docs: DataFrame, id_col: str, text_col: str, depth: int) -> DataFrame:
    """(doc_id, text_key, lines, leaves)"""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.split(F.col(text_col), "\n").alias("lines"))
    return lines.withColumn("leaves", F.transform("lines", lambda x: _leaf(x, depth)))


def _grown(forms: DataFrame, similar: float) -> DataFrame:
    """(leaf, form) of the lines that belong to their leaf's majority template."""
    tokens = forms.select("leaf", "form", "n", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    votes = tokens.groupBy("leaf", "at", "token").agg(F.sum("n").alias("n"))
    total = votes.groupBy("leaf", "at").agg(F.sum("n").alias("all"), F.max("n").alias("top"))
    constant = total.filter("2 * top > all").select("leaf", "at", "top")
    kept = votes.join(constant, ["leaf", "at"]).filter("n = top and token <> '<*>'").select("leaf", "at", "token")
    alike = tokens.join(kept, ["leaf", "at", "token"]).groupBy("leaf", "form").agg(F.count("*").alias("same"))
    size = F.size(F.split("masked", " "))
    return forms.join(alike, ["leaf", "form"]).filter(F.col("same") >= similar * size).select("leaf", "form")


def _standing(uses: DataFrame, members: DataFrame, own: DataFrame | None) -> DataFrame:
    """(leaf, form, grown, texts, own): in how many texts the template of each member stands (0: its own
    masked form); ``own(text_key)`` are the texts that are no copies."""
    marked = uses.withColumn("mine", F.lit(0)) if own is None else uses.join(own.withColumn("mine", F.lit(1)), "text_key", "left").fillna(0, ["mine"])
    exact = marked.groupBy("leaf", "form").agg(F.count("*").alias("texts"), F.sum("mine").alias("own")).withColumn("grown", F.lit(0))
    by_text = marked.join(members, ["leaf", "form"]).groupBy("leaf", "grown", "text_key").agg(F.max("mine").alias("mine"))
    grown = by_text.groupBy("leaf", "grown").agg(F.count("*").alias("texts"), F.sum("mine").alias("own"))
    return exact.unionByName(members.join(grown, ["leaf", "grown"]).select("leaf", "form", "texts", "own", "grown"))


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, min_docs: int = MIN_DOCS, similar: float = SIMILAR, grow: int | None = None) -> DataFrame:
    """(doc_id, text_key, pos) of every line that belongs to a recurring template; ``grow`` bounds the
    templates a leaf grows by similarity (None: all)."""
    parsed = _lines(docs, id_col, text_col, depth)
    held = parsed.select("text_key", F.explode(F.array_distinct("leaves")).alias("leaf")).filter("leaf <> 0").distinct()
    # a leaf in fewer texts than asked for cannot hold a template in enough of them
    leaves = materialise(held.groupBy("leaf").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs).select("leaf"), "leaves")
    few = F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves

    placed = F.transform("leaves", lambda x, i: F.struct(i.alias("pos"), x.alias("leaf"), F.trim(F.get("lines", i)).alias("line")))
    rows = parsed.select("doc_id", "text_key", F.size(F.filter("leaves", lambda x: x != 0)).alias("size"), F.explode(F.filter(placed, lambda x: x["leaf"] != 0)).alias("y"))
    rows = rows.select("doc_id", "text_key", "size", "y.pos", "y.leaf", F.regexp_replace("y.line", _FIELD, "<*>").alias("masked")).join(few, "leaf", "left_semi")
    rows = materialise(rows.withColumn("form", F.xxhash64("masked")), "lines")

    uses = materialise(rows.select("text_key", "leaf", "form").distinct(), "uses")
    # how many texts hold a form; votes are of texts, so a copied page does not outvote others with its copies' rows
    forms = rows.select("leaf", "form", "masked").distinct().join(uses.groupBy("leaf", "form").agg(F.count("*").alias("n")), ["leaf", "form"])
    left = materialise(forms, "forms")
    members, k = None, 0
    while grow is None or k < grow:
        k += 1
        more = materialise(_grown(left, similar).withColumn("grown", F.lit(k)), "members")  # read back, so that AQE can split hot leaves
        members = more if members is None else members.unionByName(more)
        # leaves that grew one go on with the rest of their forms, if these stand in enough texts
        rest = left.join(more, ["leaf", "form"], "left_anti").join(more.select("leaf").distinct(), "leaf", "left_semi")
        alive = rest.groupBy("leaf").agg(F.sum("n").alias("all")).filter(F.col("all") >= min_docs).select("leaf")
        left = materialise(rest.join(alive, "leaf", "left_semi"), "forms")
        if left.isEmpty():
            break
    candidates = materialise(_standing(uses, members, None).filter(F.col("texts") >= min_docs).select("leaf", "form").distinct(), "candidates")
    common = rows.select("text_key", "size", "pos", "leaf", "form").distinct().join(candidates, ["leaf", "form"], "left_semi").groupBy("text_key").agg(F.first("size").alias("size"), F.count("*").alias("n"))
    own = materialise(common.filter(F.col("n") <= OWN * F.col("size")).select("text_key"), "own")
    # only templates that can still recur are counted again
    again = members.join(candidates, ["leaf", "form"], "left_semi")
    chosen = _standing(uses.join(candidates, ["leaf", "form"], "left_semi"), again, own).filter((F.col("own") >= min_docs) & (F.col("own") >= SHARE * F.col("texts")))
    chosen = materialise(chosen.select("leaf", "form").distinct(), "chosen")
    return rows.join(chosen, ["leaf", "form"], "left_semi").select("doc_id", "text_key", "pos").distinct()


def drop_template_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``text`` cut and ``n_lines``, ``dropped`` (places of the dropped lines) added or replaced."""
    docs = docs.drop("n_lines", "dropped")
    with temporary_tables(docs.sparkSession):
        found = materialise(recurring_lines(docs, id_col, text_col, **options), "found", keep=True)
    gone = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.array_sort(F.collect_set("pos")).alias("dropped"))
    keyed = docs.withColumn("_text_key", F.xxhash64(text_col))
    joined = keyed.join(gone, keyed[id_col].eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left")
    lines = F.split(F.col(text_col), "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("dropped", i)), "\n")
    out = joined.withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0))).withColumn(text_col, F.when(F.col("dropped").isNull(), F.col(text_col)).otherwise(kept))
    return out.withColumn("n_lines", F.when(F.col(text_col).isNull(), 0).otherwise(F.col("n_lines"))).withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>"))).select(*docs.columns, "n_lines", "dropped")
