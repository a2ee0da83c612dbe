"""URL filter: curated rules first, then association rules that FP-growth mines from the pages those rules label.

Every URL becomes one transaction of all its host labels, path segments and other parts (`url_tokens`), tokens that occur in the same
labelled pages as one item (`token_sets`). Pages that a curated rule judges carry its verdict as one more item; FP-growth finds the
frequent combinations, and the rules `items -> verdict` that pass the support and confidence bounds, and that no more general rule
makes redundant, judge the remaining pages. Each rule is posted under its rarest item only (inverted index); a page probes the index
with its items and verifies the rest. The number of itemsets depends on the items that are frequent, not on the length of URLs.

Defined cases: a null URL or one without `://` has an empty host and path and no tokens, so no rule fits and the default
verdict holds; repeated pages are judged alike, once per distinct token set; an empty table gives an empty result; extra
columns are ignored. Ties between rules go to the higher confidence, then support, then fewer tokens, then their text.
"""

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CURATED = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
           ("net", "/es/", "block"), ("net", "/fr/", "block"))
MIN_SUPPORT, MIN_CONFIDENCE, DEFAULT = 0.01, 0.8, "allow"
LABEL = "verdict="


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def curated_match(host_col: Column, path_col: Column, rules=CURATED) -> Column:
    """Struct(rule, verdict) of the longest rule whose host covers the host and whose path starts the path."""
    found = None
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host_col == h) | host_col.endswith("." + h)) & path_col.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit) if found is None else found.when(fits, hit)
    return found


def url_tokens(url: Column, host_col: Column, path_col: Column) -> Column:
    """The sorted distinct tokens: scheme, top-level domain, every other host label, every path segment before the last, shape of the
    last one, query keys, fragment. None is left out, however long the URL."""
    labels = F.split(host_col, r"\.")
    rest = F.coalesce(_rest(url), F.lit(""))
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    tail = F.regexp_extract(path_col, r"([^/]*/?)$", 1)
    kinds = (("scheme=", F.array(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))),
             ("tld=", F.array(F.element_at(labels, -1))), ("label=", F.slice(labels, 1, F.size(labels) - 1)),
             ("seg=", F.split(F.regexp_extract(path_col, r"(?s)^(.*)/", 1), "/")),
             ("last=", F.array(F.regexp_replace(tail, "[0-9]+", "0"))),
             ("query=", F.array(F.regexp_replace(query, "=[^&]*", ""))), ("frag=", F.array(F.regexp_extract(rest, "(?s)#(.+)$", 1))))
    return F.array_sort(F.array_distinct(F.concat(*[_with_kind(kind, values) for kind, values in kinds])))


def _with_kind(kind: str, values: Column) -> Column:
    return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(kind), v))


def judged_pages(pages: DataFrame, rules=CURATED) -> DataFrame:
    """page_id, host, path, rule and verdict (null where no curated rule fits) and tokens."""
    parts = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    hit = parts.withColumn("hit", curated_match(F.col("host"), F.col("path"), rules))
    return hit.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("verdict"),
                      F.when(F.col("host") != "", url_tokens(F.col("url"), F.col("host"), F.col("path")))
                      .otherwise(F.array().cast("array<string>")).alias("tokens"))


def token_sets(judged: DataFrame, min_support=MIN_SUPPORT) -> DataFrame:
    """tokens (a distinct set) and items: the classes of its tokens.

    Tokens that are frequent among the labelled pages and occur in the very same ones form a class, named by its least token: any rule
    on one of them holds on each, with equal support and confidence, and one with several of them is redundant. So FP-growth sees one
    item for the class, and a long path that thousands of pages share does not give all its subsets. Infrequent tokens have no class.
    Covers are compared by the number and two 64-bit hashes of the distinct labelled sets that hold the token.
    """
    sets = stage(judged.groupBy("tokens").agg(F.count("verdict").alias("n")), "url-sets")
    labelled = sets.select(F.explode("tokens").alias("token"), "n", F.xxhash64("tokens").alias("h"),
                           F.xxhash64("tokens", "n").cast("decimal(38)").alias("g")).filter("n > 0")
    need = sets.agg(F.ceil(F.sum("n") * F.lit(float(min_support))).alias("need"))
    covers = labelled.groupBy("token").agg(F.sum("n").alias("freq"), F.count("n").alias("k"), F.bit_xor("h").alias("h"), F.sum("g").alias("g"))
    same = Window.partitionBy("freq", "k", "h", "g")
    frequent = covers.join(F.broadcast(need), F.col("freq") >= F.col("need"))  # one row
    classes = stage(frequent.select("token", F.min("token").over(same).alias("item")), "url-classes")
    items = (sets.select("tokens", F.explode("tokens").alias("token")).join(classes, "token")
             .groupBy("tokens").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return stage(sets.select("tokens").join(items, "tokens", "left").select(
        "tokens", F.coalesce("items", F.array().cast("array<string>")).alias("items")), "url-items")


def mine_rules(judged: DataFrame, sets: DataFrame, min_support=MIN_SUPPORT, min_confidence=MIN_CONFIDENCE) -> DataFrame:
    """antecedent (sorted classes), verdict, confidence, support, posted: the pruned rules, each with its rarest class."""
    labelled = judged.filter("verdict IS NOT NULL").join(sets, "tokens").select(
        F.concat("items", F.array(F.concat(F.lit(LABEL), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(labelled)
    rules = stage(model.associationRules.filter(F.col("consequent")[0].startswith(LABEL)).select(
        F.array_sort("antecedent").alias("antecedent"),
        F.substring(F.col("consequent")[0], len(LABEL) + 1, 100).alias("verdict"), "confidence", "support"), "url-rules")
    single = stage(model.freqItemsets.filter("size(items) = 1").select(F.col("items")[0].alias("token"), "freq"), "url-single")
    rarest = (rules.select("antecedent", F.explode("antecedent").alias("token")).distinct()
              .join(single, "token").groupBy("antecedent").agg(F.min_by("token", F.struct("freq", "token")).alias("posted")))
    posted = stage(rules.join(rarest, "antecedent"), "url-posted")
    general = posted.select("posted", F.col("antecedent").alias("less"), F.col("verdict").alias("same"),
                            F.col("confidence").alias("as_sure"))
    redundant = (rules.select("antecedent", "verdict", "confidence", F.explode("antecedent").alias("token"))
                 .join(general, F.col("token") == F.col("posted"))
                 .filter("same = verdict AND as_sure >= confidence AND size(less) < size(antecedent) "
                         "AND size(array_except(less, antecedent)) = 0")
                 .select("antecedent", "verdict").distinct())
    return stage(posted.join(redundant, ["antecedent", "verdict"], "left_anti"), "url-pruned")


def apply_rules(judged: DataFrame, sets: DataFrame, rules: DataFrame, default=DEFAULT) -> DataFrame:
    """Judge the pages without a curated verdict; sets from token_sets, rules from mine_rules.

    The index of rules is a stored table without a hint: Spark broadcasts it below its own threshold and shuffles it beyond.
    """
    fired = (sets.select("tokens", "items", F.explode("items").alias("item"))
             .join(rules.withColumnRenamed("verdict", "mined"), F.col("item") == F.col("posted"))
             .filter("size(array_except(antecedent, items)) = 0"))
    # Written, so that the join below exchanges both sides and a token set of very many pages can be split.
    best = stage(fired.groupBy("tokens").agg(F.min(F.struct(
        (-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), F.size("antecedent").alias("n"),
        F.array_join("antecedent", " ").alias("because"), "mined")).alias("best")), "url-verdicts")
    return judged.join(best, "tokens", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "best.mined", F.lit(default)).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("best.because")).alias("because"))


def filter_urls(pages: DataFrame, rules=CURATED, min_support=MIN_SUPPORT, min_confidence=MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict and because (the mined rule's token classes) of every page."""
    judged = judged_pages(pages, rules)
    sets = token_sets(judged, min_support)
    return apply_rules(judged, sets, mine_rules(judged, sets, min_support, min_confidence))
