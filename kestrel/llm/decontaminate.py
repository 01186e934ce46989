"""Benchmark decontamination by a positional inverted index (operator 10).

Words are runs of digits, a-z (A-Z lowered) and non-ASCII characters. A test
window is 10 consecutive words of an item (a shorter item is one window).

1. Corpus counts of the test terms over all documents.
2. Each distinct window picks its two rarest terms; a window with a term
   that the corpus lacks cannot occur.
3. The positional postings of these terms are stored, each with the words
   around it.
4. The offset-adjusted lists are intersected: a start is kept where both
   terms stand at their offsets, then all words are compared.

All joins are on a term or on a (document, position), never on a document
pair; the sides made of test windows are broadcast only after a count. Only
DataFrame functions run on the executors.

Defined cases: null or empty texts have no words, hit nothing and get
n_items 0 and the hash of the empty string; rows equal in doc_id and text
get equal results (repeated rows stay repeated); a null item_id is not
listed; items with equal texts are all listed; an empty table on either side
works; columns other than doc_id, text, item_id are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.text import let
from kestrel.storage import broadcast_if_small, materialize

WINDOW = 10
MAX_BROADCAST_ROWS = 200_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def index_words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def test_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, phrase, terms): every window of every item."""
    w = items.select("item_id", index_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)))
    return (w.select("item_id", "words", F.explode(starts).alias("s"))
            .select("item_id", F.slice("words", F.col("s"), F.lit(window)).alias("terms"))
            .select("item_id", F.array_join("terms", " ").alias("phrase"), "terms").distinct())


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences of each of ``terms`` in all documents (absent ones are
    left out); counted before the shuffle."""
    return (docs.select(F.explode(index_words(F.col("text"))).alias("term"))
            .join(broadcast_if_small(terms, MAX_BROADCAST_ROWS), "term")
            .groupBy("term").agg(F.count(F.lit(1)).alias("n")))


def rarest_terms(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """Per phrase the rarest term and the second rarest with their offsets
    (equal where the phrase has one word); phrases with an absent term go."""
    terms = phrases.select("phrase", F.size("terms").alias("len"), F.posexplode("terms").alias("off", "term"))
    per = (terms.join(counts, "term")
           .groupBy("phrase", "len").agg(F.array_sort(F.collect_list(F.struct("n", "term", "off"))).alias("by_n"))
           .where(F.size("by_n") == F.col("len")))
    rare, next_ = F.col("by_n")[0], F.col("by_n")[F.least(F.lit(1), F.col("len") - 1)]
    return per.select("phrase", "len", rare["term"].alias("term"), rare["off"].alias("off"),
                      next_["term"].alias("term2"), next_["off"].alias("off2"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_h"), index_words(F.col("text")).alias("words"))


def postings(docs: DataFrame, terms: DataFrame, around: int = 0) -> DataFrame:
    """Positional postings (term, doc_id, text_h, pos) of ``terms`` in all
    documents; with ``around``, the words up to that far on either side as
    ``near`` and the position of the first of them as ``near_from``."""
    p = (_keyed(docs).select("doc_id", "text_h", "words", F.posexplode("words").alias("pos", "term"))
         .join(broadcast_if_small(terms, MAX_BROADCAST_ROWS), "term"))
    cols = ["term", "doc_id", "text_h", "pos"]
    if around:
        first = F.greatest(F.lit(0), F.col("pos") - around)
        cols += [F.slice("words", first + 1, F.col("pos") - first + 1 + around).alias("near"), first.alias("near_from")]
    return p.select(*cols)


def phrase_matches(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """(doc_id, text_h, phrase, start, len) of every occurrence of every
    phrase (``phrases``: phrase, terms)."""
    counts = materialize(term_counts(docs, phrases.select(F.explode("terms").alias("term")).distinct()), "term-counts")
    rare = materialize(rarest_terms(phrases, counts), "rare-terms")
    longest = rare.agg(F.max("len")).first()[0] or 1

    shapes = rare.select("term", "off", "len", "term2", "off2").distinct()
    wanted = rare.select("term").union(rare.select("term2")).distinct()
    index = materialize(postings(docs, wanted, around=max(1, longest - 1)), "postings")
    second = index.select(F.col("term").alias("term2"), "doc_id", "text_h", F.col("pos").alias("pos2"))

    cand = (index.join(broadcast_if_small(shapes, MAX_BROADCAST_ROWS), "term")
            .withColumn("start", F.col("pos") - F.col("off")).where(F.col("start") >= 0)
            .withColumn("pos2", F.col("start") + F.col("off2"))
            .withColumn("phrase", F.array_join(F.slice("near", F.greatest(F.lit(1), F.col("start") - F.col("near_from") + 1), F.col("len")), " ")))
    c, s = cand.alias("c"), second.alias("s")
    both = c.join(s, (F.col("c.term2") == F.col("s.term2")) & F.col("c.doc_id").eqNullSafe(F.col("s.doc_id"))
                  & (F.col("c.text_h") == F.col("s.text_h")) & (F.col("c.pos2") == F.col("s.pos2")), "left_semi")
    found = both.join(broadcast_if_small(rare.select("phrase"), MAX_BROADCAST_ROWS), "phrase", "left_semi")
    return found.select("doc_id", "text_h", "phrase", "start", "len").distinct()


def _covered(spans: Column) -> Column:
    """Length of the union of (start, end) intervals."""
    step = lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], acc["end"]))).cast("long").alias("n"),
        F.greatest(acc["end"], x["end"]).cast("int").alias("end"))
    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
                       step, lambda acc: acc["n"])


def contaminated_words(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_h, n_hit, n_items, items_sha256) of the documents with
    an occurrence of a test window."""
    windows = materialize(test_windows(items, window), "windows")
    found = materialize(phrase_matches(docs, windows.groupBy("phrase").agg(F.first("terms").alias("terms"))), "matches")
    hits = found.groupBy("doc_id", "text_h").agg(
        _covered(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end")))).alias("n_hit"))
    named = (found.select("doc_id", "text_h", "phrase").distinct()
             .join(windows.select("phrase", F.col("item_id").cast("string").alias("item")), "phrase")
             .groupBy("doc_id", "text_h").agg(F.array_sort(F.collect_set("item")).alias("items")))
    h, n = hits.alias("h"), named.alias("n")
    return (h.join(n, F.col("h.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("h.text_h") == F.col("n.text_h")))
            .select("h.doc_id", "h.text_h", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256")))


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The report on every document."""
    hits = materialize(contaminated_words(docs, items, window), "hits")
    base = docs.select("doc_id", F.xxhash64("text").alias("text_h"),
                       F.size(index_words(F.col("text"))).cast("long").alias("n_words")).alias("d")
    h = broadcast_if_small(hits, MAX_BROADCAST_ROWS).alias("h")
    j = base.join(h, F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_h") == F.col("h.text_h")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return j.select("d.doc_id", "n_words", n_hit.alias("n_hit"),
                    F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any test window, columns unchanged."""
    hits = materialize(contaminated_words(docs, items, window), "hits")
    hits = broadcast_if_small(hits.select(F.col("doc_id").alias("hit_doc"), F.col("text_h").alias("hit_text")), MAX_BROADCAST_ROWS)
    on = docs["doc_id"].eqNullSafe(hits["hit_doc"]) & (F.xxhash64(docs["text"]) == hits["hit_text"])
    return docs.join(hits, on, "left_anti")


def proximity_matches(docs: DataFrame, items: DataFrame, n_terms: int = 3, slop: int = 5) -> DataFrame:
    """(doc_id, text_h, item_id): the item's ``n_terms`` rarest distinct terms
    (all its terms, if fewer) that the corpus has all stand in the document
    with offset-adjusted starts at most ``slop`` apart, each by any of its
    offsets in the item; an item of which the corpus has fewer terms than that
    matches nothing. Starts are bucketed by slop + 1 and put into two neighbouring
    buckets, so one group holds one stretch of one document."""
    words = items.select("item_id", F.posexplode(index_words(F.col("text"))).alias("off", "term"))
    offsets = words.groupBy("item_id", "term").agg(F.collect_set("off").alias("offs"))
    counts = term_counts(docs, offsets.select("term").distinct())
    per = (offsets.join(counts, "term", "left").groupBy("item_id")
           .agg(F.least(F.count(F.lit(1)), F.lit(n_terms)).alias("want"),
                F.slice(F.array_sort(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("n", "term", "offs")))), 1, n_terms).alias("t"))
           .where(F.size("t") == F.col("want")))
    rare = materialize(per.select("item_id", "want", F.explode("t").alias("t"))
                       .select("item_id", "want", "t.term", F.explode("t.offs").alias("off")), "near-terms")
    p = materialize(postings(docs, rare.select("term").distinct()), "near-postings").join(broadcast_if_small(rare, MAX_BROADCAST_ROWS), "term")
    start = F.col("pos") - F.col("off")
    b = F.floor(start / (slop + 1))
    spread = p.select("item_id", "want", "doc_id", "text_h", "term", start.alias("start"),
                      F.explode(F.array(b, b - 1)).alias("bucket"))
    g = (spread.groupBy("item_id", "want", "doc_id", "text_h", "bucket")
         .agg(F.array_sort(F.collect_set(F.struct("start", "term"))).alias("s")))
    # from each start as the lowest, do the starts within slop hold all terms?
    full = let(F.col("s"), lambda s: F.exists(s, lambda x: F.size(F.array_distinct(F.transform(
        F.filter(s, lambda y: (y["start"] >= x["start"]) & (y["start"] <= x["start"] + slop)),
        lambda y: y["term"]))) == F.col("want")))
    return g.where(full).select("doc_id", "text_h", "item_id").distinct()


def near_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_near_items, near_items_sha256) of every document: the items
    with a proximity match."""
    hits = materialize(proximity_matches(docs, items).groupBy("doc_id", "text_h")
                       .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")), "near-hits")
    base = docs.select("doc_id", F.xxhash64("text").alias("text_h")).alias("d")
    h = broadcast_if_small(hits, MAX_BROADCAST_ROWS).alias("h")
    j = base.join(h, F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_h") == F.col("h.text_h")), "left")
    found = F.coalesce("items", F.array().cast("array<string>"))
    return j.select("d.doc_id", F.size(found).cast("long").alias("n_near_items"),
                    F.sha2(F.array_join(found, ","), 256).alias("near_items_sha256"))
