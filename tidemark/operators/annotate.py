"""Cluster annotation and headline keywords."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import engagement as eng
from tidemark.functions import repair
from tidemark.functions import text as tx
from tidemark.operators import normalize, ranking, rollup
from tidemark.runtime import cut, dealt

INSTRUCTIONS = (
    "Reply with one JSON object with the fields topic, summary, sentiment (positive, negative or "
    "neutral), keywords, content_type (entertainment, drama, dangerous, social_issue or "
    "commercial), risk_level (safe, cautious, high_risk or dangerous) and guidelines "
    "(for_marketers, for_social_managers)."
)

# Our own word lists of the offline annotator.
POSITIVE = ("good", "great", "love", "best", "win", "happy", "bon", "gut", "bueno", "tốt", "vui")
NEGATIVE = ("bad", "worst", "hate", "sad", "fail", "mal", "schlecht", "malo", "xấu", "buồn")
TYPE_WORDS = {
    "dangerous": ("danger", "poison", "weapon", "injury", "nguy"),
    "social_issue": ("protest", "poverty", "flood", "policy", "rights", "lũ"),
    "drama": ("scandal", "drama", "gossip", "feud"),
    "commercial": ("sale", "discount", "brand", "buy", "price", "shop"),
}
CATEGORY_WORDS = {
    "giải trí": ("film", "music", "game", "show", "star", "phim", "nhạc"),
    "công nghệ": ("ai", "tech", "phone", "app", "robot", "chip"),
    "lifestyle": ("style", "home", "food", "fashion"),
    "sức khỏe": ("health", "doctor", "fitness", "diet"),
    "xe": ("car", "bike", "motor"),
    "du lịch": ("travel", "tour", "beach", "hotel"),
    "thể thao": ("sport", "match", "goal", "team"),
}
OTHER_CATEGORY = "khác"
SKIPPED_WORDS = ("army", "war", "court", "police", "minister", "parliament")


def _has(words: Column, lexicon) -> Column:
    return F.arrays_overlap(words, F.array(*[F.lit(w) for w in lexicon]))


def build_requests(df: DataFrame, top: int = 10, chars: int = 300, key: str = "cluster_id",
                   instructions: str = INSTRUCTIONS) -> DataFrame:
    """One request text per cluster: source tally, numbered top texts, instructions."""
    tally = rollup.source_rows(df, key).withColumn("line", F.concat(
        F.lit("- "), normalize.label(F.col("source"), normalize.SOURCE_LABELS,
                                     F.upper(F.col("source"))),
        F.lit(": "), F.col("n").cast("string"), F.lit(" items")))
    head = tally.groupBy(key).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "source", "line"))),
        lambda x: x["line"]), "\n").alias("head"))
    slim = df.select(  # shortened before the sort, so whole texts never travel
        key, "ingest_seq", eng.item_score().alias("_score"), F.concat(
            F.lit(". ["), normalize.label(F.col("source"), normalize.SAMPLE_SOURCE_LABELS),
            F.lit("] "), tx.cut(F.col("text"), chars)).alias("shown"))
    order = [F.col("_score").desc(), F.col("ingest_seq").asc()]
    best = ranking.top_k(slim, top, key, order).withColumn(
        "line", F.concat(F.col("rank").cast("string"), "shown"))
    body = best.groupBy(key).agg(  # at most `top` rows a group
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "line"))),
                                 lambda x: x["line"]), "\n").alias("body"),
        F.count(F.lit(1)).alias("shown"))
    return head.join(body, key).select(key, F.concat(
        F.lit("Sources:\n"), "head", F.lit("\n\nSamples (first "), F.col("shown").cast("string"),
        F.lit("):\n"), "body", F.lit("\n\n" + instructions)).alias("request"))


def _guarded(fn: Callable[[str], str]):
    @F.pandas_udf(T.StringType())
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(request: str) -> str | None:
            try:
                return fn(request)
            except Exception:  # one failing cluster must not stop the others
                return None
        for part in parts:
            yield part.map(one)
    return run


def annotate(requests: DataFrame, fn: Callable[[str], str],
             key: str = "cluster_id", calls: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(annotated, rejected).  Rejected: the call failed, or its JSON lacks a required field.

    The requests are dealt by key to ``calls`` tasks, as many as the cluster has cores if none are named, and each
    is asked once: the answers are written before both results are read from them.
    """
    answered = cut(dealt(requests, key, calls).withColumn("answer", _guarded(fn)("request")))
    return read_answers(answered, key)


def read_answers(answered: DataFrame, key: str = "cluster_id") -> tuple[DataFrame, DataFrame]:
    read = answered.withColumn("_a", repair.read_annotation(repair.repair_json(F.col("answer"))))
    required = ("topic", "summary", "sentiment", "keywords")
    ok = F.lit(True)
    for name in required:
        ok = ok & F.col(f"_a.{name}").isNotNull()
    return read.filter(ok).select(key, "_a.*"), read.filter(~ok).select(key, "answer")


def terms(df: DataFrame, key: str = "cluster_id", text: str = "text") -> DataFrame:
    """(key, term, n): word counts per cluster over whole texts; counted before the shuffle."""
    words = df.select(key, F.explode(tx.pieces(F.col(text))).alias("term"))
    return words.filter("term <> ''").groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def class_terms(counted: DataFrame, k: int = 5, key: str = "cluster_id") -> DataFrame:
    """Top ``k`` terms per cluster by class TF-IDF: share in the cluster x ln(1 + mean / total)."""
    totals = counted.groupBy(key).agg(F.sum("n").alias("words"))
    mean = totals.agg(F.avg("words")).scalar()
    spread = counted.groupBy("term").agg(F.sum("n").alias("everywhere"))
    scored = counted.join(spread, "term").join(totals, key).withColumn(
        "score", F.round(F.col("n") / F.col("words") * F.log(
            F.lit(1.0) + mean / F.col("everywhere")), 9))
    return ranking.top_k(scored, k, key, [F.col("score").desc(), F.col("term")]).select(
        key, "rank", "term", "score")


def learn_words(labelled: DataFrame, label: str = "label", text: str = "text", prior: float = 0.5,
                least: float = 4.0) -> DataFrame:
    """(label, term, weight): how much a word speaks for each label, learnt from the caller's labelled texts.

    The unit is a word of a text, counted once a text; a label's units are all its texts' different words, so long
    texts do not make every word speak for their label.  The weight is the log-odds of the word among the label's units,
    less that among all others, with ``prior`` added to each of the four counts; words whose weight is less than
    ``least`` standard errors from zero are left out (4, because thousands of words are tried).  The empty term holds the
    log-odds of the label itself.  Only aggregates; copies of one text count each.  Rows without a label teach nothing.
    With one label only nothing is learnt.
    """
    known = labelled.filter(F.col(label).isNotNull()).select(F.col(label).alias("label"), text)
    held = cut(known.select("label", F.explode(F.array_distinct(tx.pieces(F.col(text)))).alias("term")).filter(
        "term <> ''").groupBy("label", "term").agg(F.count(F.lit(1)).alias("n")))
    sizes = held.groupBy("label").agg(F.sum("n").alias("units"))
    every = held.agg(F.sum("n")).scalar()
    whole = held.groupBy("term").agg(F.sum("n").alias("everywhere"))
    inside, outside = F.col("n") + prior, F.col("everywhere") - F.col("n") + prior
    no_inside = F.col("units") - F.col("n") + prior
    no_outside = every - F.col("units") - (F.col("everywhere") - F.col("n")) + prior
    texts = F.sum("texts").over(Window.partitionBy())  # a row a label
    before = known.groupBy("label").agg(F.count(F.lit(1)).alias("texts")).withColumn("rest", texts - F.col("texts")).filter(
        "rest > 0").select("label", F.lit("").alias("term"), F.log(F.col("texts") / F.col("rest")).alias("weight"))
    return held.join(whole, "term").join(sizes, "label").withColumn(
        "weight", F.log(inside / no_inside) - F.log(outside / no_outside)).filter(
        (every > F.col("units")) & (F.abs("weight") >= least * F.sqrt(
            1 / inside + 1 / no_inside + 1 / outside + 1 / no_outside))).select(
        "label", "term", "weight").unionByName(before)


def judge(counted: DataFrame, words: DataFrame, key: str = "cluster_id") -> DataFrame:
    """(key, label, score): the label for which the words of a text or cluster speak most, counted (key, term, n).

    The score is the label's own log-odds and the weights of the different words; equal scores go to the smaller label.
    Labels compete whose words the key holds; a key without a learnt word has no row.
    """
    own = words.filter("term = ''").select("label", F.col("weight").alias("own"))
    sums = counted.filter("term <> ''").join(words, "term").groupBy(key, "label").agg(F.sum("weight").alias("w"))
    scored = sums.join(own, "label").select(key, "label", F.round(F.col("w") + F.col("own"), 9).alias("score"))
    return ranking.top_k(scored, 1, key, [F.col("score").desc(), F.col("label")]).select(key, "label", "score")


def _guidelines(kind: Column, risk: Column) -> Column:
    """Rule table from type and risk to advice."""
    safe, watch = risk.isin("safe", "cautious"), risk.isin("high_risk", "dangerous")

    def texts(*values: str) -> Column:
        return F.array(*[F.lit(v) for v in values])

    marketers = F.struct(
        safe.alias("should_participate"),
        F.when(safe, "Taking part fits most brands.").otherwise("Stay away from this topic.")
        .alias("summary"),
        F.when(safe, texts("Join early", "Credit the creators")).otherwise(texts()).cast(
            "array<string>").alias("recommendations"),
        F.when(watch, texts("Brand may be tied to harm")).otherwise(texts()).cast(
            "array<string>").alias("warnings"),
        F.concat(F.lit("Type "), kind, F.lit(", risk "), risk, F.lit(".")).alias("detailed_advice"))
    managers = F.struct(
        watch.alias("intervention_needed"),
        F.when(watch, "Act now.").otherwise("No action needed.").alias("summary"),
        F.when(watch, texts("Review the posts", "Limit reach")).otherwise(texts()).cast(
            "array<string>").alias("actions"),
        texts("Growth of the topic", "Tone of the replies").alias("monitoring_points"),
        F.concat(F.lit("Type "), kind, F.lit(", risk "), risk, F.lit(".")).alias(
            "detailed_analysis"))
    return F.struct(marketers.alias("for_marketers"), managers.alias("for_social_managers")).cast(
        schemas.GUIDELINES)


def annotate_offline(df: DataFrame, key: str = "cluster_id", k: int = 5, tone_words: DataFrame | None = None,
                     type_words: DataFrame | None = None) -> DataFrame:
    """Default annotator in plain DataFrame operations.

    Topic and keywords: class TF-IDF.  Sentiment and type: words learnt by :func:`learn_words` from the caller's
    labelled texts (labels as in the trend table; a cluster without a learnt word is neutral, entertainment), without
    them counts of listed words.  Risk follows the type.
    """
    counted = cut(terms(df, key))  # read four times below
    best = class_terms(counted, k, key).groupBy(key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))),
                    lambda x: x["term"]).alias("keywords"))

    def hits(words) -> Column:
        return F.coalesce(F.sum(F.when(F.col("term").isin(*words), F.col("n"))), F.lit(0))

    tone = counted.groupBy(key).agg(
        (hits(POSITIVE) - hits(NEGATIVE)).alias("tone"),
        *[hits(words).alias(name) for name, words in TYPE_WORDS.items()])
    kind = F
    for name in TYPE_WORDS:
        others = [F.col(o) for o in TYPE_WORDS if o != name]
        kind = kind.when((F.col(name) > 0) & (F.col(name) >= F.greatest(*others)), F.lit(name))
    kind = kind.otherwise(F.lit("entertainment"))
    risk = (
        F.when(F.col("content_type") == "dangerous", "dangerous")
        .when(F.col("content_type") == "social_issue", "high_risk")
        .when(F.col("content_type") == "drama", "cautious").otherwise("safe"))
    out = (
        df.select(key).distinct().join(tone, key, "left").join(best, key, "left")
        .withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>")))
        .withColumn("topic", F.array_join(F.slice("keywords", 1, 3), " "))
        .withColumn("summary", F.concat(F.lit("Mostly about "), F.array_join("keywords", ", ")))
        .withColumn("sentiment", F.when(F.col("tone") > 0, "positive").when(
            F.col("tone") < 0, "negative").otherwise("neutral"))
        .withColumn("content_type", kind)
    )
    for name, words, other in (("sentiment", tone_words, "neutral"), ("content_type", type_words, "entertainment")):
        if words is not None:
            learnt = judge(counted, words, key).select(key, F.col("label").alias("_label"))
            out = out.join(learnt, key, "left").withColumn(name, F.coalesce("_label", F.lit(other))).drop("_label")
    out = out.withColumn("risk_level", risk)
    return out.withColumn("guidelines", _guidelines(F.col("content_type"), F.col("risk_level"))
                          ).select(key, "topic", "summary", "sentiment", "keywords",
                                   "content_type", "risk_level", "guidelines")


def build_trends(items: DataFrame, annotated: DataFrame, now, sample_top: int = 5,
                 key: str = "cluster_id") -> DataFrame:
    """One new trend per annotated cluster; totals over all its items."""
    from tidemark.functions import times

    stamp = times.clock(now)
    return (
        annotated.join(rollup.trend_rollup(items, key), key)
        .join(rollup.source_counts(items, key), key)
        .join(ranking.samples(items, sample_top, key), key)
        .select(
            F.concat(F.date_format(stamp, "yyyyMMddHHmmss"), F.lit("-"),
                     F.col(key).cast("string")).alias("trend_id"),
            stamp.alias("timestamp"), stamp.alias("last_updated"), "topic", "summary", "sentiment",
            "keywords", "video_count", "total_views", "total_likes", "sample_videos",
            "source_counts", "content_type", "risk_level", "guidelines")
    )


def ngrams(words: Column, size: int) -> Column:
    """Distinct runs of ``size`` consecutive words."""
    last = F.size(words) - (size - 1)
    starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(
        F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " ")))


def top_phrases(listed: DataFrame, n: int, low: int = 2, high: int = 5) -> DataFrame:
    """(keyword, hits): the ``n`` phrases of ``low`` to ``high`` words in most rows of ``words``; equal counts go to
    the longer phrase, then the smaller text.  Phrases with skipped words are left out.

    Exact in two steps.  The shortest phrases are counted first; the ``n``-th of them is in ``least`` rows, so a longer
    phrase is wanted only if it is in as many, and then so are all shortest phrases in it.  Only places where
    such phrases follow one another are shuffled again.
    """
    rows = cut(listed.select(F.monotonically_increasing_id().alias("row"), "words"))

    def usable(phrase: str) -> Column:
        return ~_has(F.split(phrase, " "), SKIPPED_WORDS)

    short = cut(rows.select(F.explode(ngrams(F.col("words"), low)).alias("keyword")).groupBy("keyword").agg(
        F.count(F.lit(1)).alias("hits")).filter(usable("keyword")))
    least = short.orderBy(F.col("hits").desc()).limit(n).agg(F.min("hits")).first()[0]
    # none, if nothing was counted; written, so that its size is known before all places are dealt out to meet it
    often = cut(short.filter(F.col("hits") >= F.lit(least)))
    starts = F.sequence(F.lit(1), F.size("words") - (low - 1))
    places = rows.filter(F.size("words") >= low).select("row", F.posexplode(F.transform(
        starts, lambda i: F.slice("words", i, high))).alias("at", "ahead")).withColumn(
        "keyword", F.array_join(F.slice("ahead", 1, low), " ")).join(often, "keyword", "left_semi")
    by_place = Window.partitionBy("row").orderBy("at")
    more = sum((F.coalesce(F.lead("at", j).over(by_place) == F.col("at") + j, F.lit(False)).cast("int")
                for j in range(1, high - low + 1)), F.lit(0))
    longer = places.withColumn("more", more).filter("more > 0").select("row", F.explode(F.transform(
        F.sequence(F.lit(low + 1), F.col("more") + low),
        lambda k: F.array_join(F.slice("ahead", F.lit(1), k), " "))).alias("keyword")).distinct()
    both = often.unionByName(longer.groupBy("keyword").agg(F.count(F.lit(1)).alias("hits")))
    return both.orderBy(F.col("hits").desc(), F.size(F.split("keyword", " ")).desc(), "keyword").limit(n)


def extract_keywords(headlines: DataFrame, now, n: int = 30, low: int = 2,
                     high: int = 5) -> DataFrame:
    """Phrases of 2-5 words in most headlines, with category, reason and run metadata.

    All titles count; phrases with skipped words are left out.
    """
    from tidemark.functions import times

    listed = headlines.select(tx.tokens(F.col("title")).alias("words"))
    parts = F.split("keyword", " ")
    category = F
    for name, lexicon in CATEGORY_WORDS.items():
        category = category.when(_has(parts, lexicon), F.lit(name))
    total = listed.agg(F.count(F.lit(1))).scalar()
    return (
        top_phrases(listed, n, low, high).select(
            "keyword", category.otherwise(F.lit(OTHER_CATEGORY)).alias("category"),
            F.concat(F.lit("in "), F.col("hits").cast("string"), F.lit(" headlines")).alias("reason"),
            times.clock(now).alias("extracted_at"), F.lit("pending").alias("status"),
            F.lit("news").alias("source"), total.alias("num_headlines"))
    )


def extract_with(headlines: DataFrame, now, fn: Callable[[str], str], order: str = "ingest_seq",
                 n: int = 30, most: int = 1000) -> DataFrame:
    """Same result layout from a caller's function.  One request holds the first ``most`` titles."""
    from tidemark.functions import times

    lines = F.transform(F.sort_array(F.collect_list(F.struct(order, "title"))),
                        lambda x: F.concat(F.lit("- "), x["title"]))
    request = headlines.orderBy(order).limit(most).agg(
        F.concat(F.lit(f"List the {n} phrases with most potential as JSON.\n"),
                 F.array_join(lines, "\n")).alias("request"),
        F.count(F.lit(1)).alias("num_headlines")).filter("num_headlines > 0")
    answer = request.withColumn("a", F.from_json(
        _guarded(fn)("request"),
        "keywords array<struct<keyword:string,category:string,reason:string>>"))
    return answer.select("num_headlines", F.explode("a.keywords").alias("k")).select(
        "k.*", times.clock(now).alias("extracted_at"), F.lit("pending").alias("status"),
        F.lit("news").alias("source"), "num_headlines")
