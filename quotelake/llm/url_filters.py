"""URL filters: stated rules first, then association rules mined from labels.

Host labels (from the right) and path steps (from the left) are tokens of their own;
what lies beyond the last slot of either is one token. A URL so has at most
``len(SLOTS)`` tokens and ``2 ** len(SLOTS)`` combinations, which bounds what
FP-growth makes of a URL that is repeated. Rules are pruned by how many blocked URLs
they rest on, an absolute number, and by their lift over the share of blocked URLs
among all labelled ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import ascii_lower, computed, written

SLOTS = ("host1", "host2", "host3", "hosts", "path1", "path2", "paths", "query", "fragment")
BLOCKED = "label=block"
#: Over how many keys a token's pages are dealt where rules are joined by a shuffle.
SALTS = 32
#: Most bytes of rules that are broadcast, and what a rule takes besides its texts.
RULE_BYTES, RULE_WIDTH = 32 << 20, 256


@dataclass(frozen=True)
class Rule:
    """``host/path`` with its verdict; fits the host and all its subdomains."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


@dataclass(frozen=True)
class MiningConfig:
    """Least number of blocked URLs with a combination, the least share of blocked ones
    among its URLs, that share's least ratio to the one of all labelled URLs, and how
    many labelled URLs are mined. The last bounds the tokens that FP-growth ranks in the
    driver; counts of rules are those of the mined URLs."""

    min_count: int = 5
    min_confidence: float = 0.3
    min_lift: float = 1.5
    sample_rows: int = 200_000


def url_parts(url: Column) -> dict[str, Column]:
    """Host (A-Z lower-cased), path, query and fragment; all empty without ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    raw = F.regexp_extract(after, r"^([^/?#]*)", 1)
    rest = F.substring(after, F.length(raw) + 1, F.length(after))
    return {
        "host": ascii_lower(raw),
        "path": F.regexp_extract(rest, r"^([^?#]*)", 1),
        "query": F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1),
        "fragment": F.regexp_extract(rest, r"#([\s\S]*)$", 1),
    }


def stated_rule(host: Column, path: Column, rules: list[Rule], pick) -> Column:
    """``pick(rule)`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = fits & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.lit(pick(rule))).otherwise(found)
    return found


def url_tokens(host: Column, path: Column, query: Column, fragment: Column) -> Column:
    """One token for each slot of a URL that is not empty."""
    labels = F.reverse(F.filter(F.split(host, r"\."), lambda x: x != ""))
    steps = F.filter(F.split(path, "/"), lambda x: x != "")
    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    keys = F.array_sort(F.array_distinct(F.filter(keys, lambda x: x != "")))
    beyond = lambda parts, n: F.when(
        F.size(parts) > n, F.array_join(F.slice(parts, F.lit(n + 1), F.size(parts)), "/")
    )
    values = {
        "host1": F.get(labels, F.lit(0)),
        "host2": F.get(labels, F.lit(1)),
        "host3": F.get(labels, F.lit(2)),
        "hosts": beyond(labels, 3),
        "path1": F.get(steps, F.lit(0)),
        "path2": F.get(steps, F.lit(1)),
        "paths": beyond(steps, 2),
        "query": F.when(F.size(keys) > 0, F.array_join(keys, "&")),
        "fragment": F.when(fragment != "", fragment),
    }
    tokens = [F.concat(F.lit(f"{slot}="), values[slot]) for slot in SLOTS]
    return F.array_compact(F.array(*tokens))


def mine_rules(labelled: DataFrame, cfg: MiningConfig = MiningConfig()) -> DataFrame:
    """Rules ``tokens -> block`` from rows of ``page_id``, ``url``, ``tokens`` and boolean
    ``blocked``.

    Rows: tokens (sorted), support, confidence, and the token it is indexed by,
    which is its rarest one. Fewer than ``min_count`` blocked rows give no rules. Of more
    than ``sample_rows`` rows about that many are mined, chosen by a hash.
    """
    spark = labelled.sparkSession
    label = F.when(F.col("blocked"), F.array(F.lit(BLOCKED))).otherwise(F.array().cast("array<string>"))
    hashed = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30))
    baskets = written(
        labelled.select(F.concat("tokens", label).alias("items"), "blocked", hashed.alias("hashed")),
        "url-baskets",
    )
    share = min(1.0, cfg.sample_rows / max(1, baskets.count()))
    baskets = baskets.filter(F.col("hashed") < int(share * (1 << 30)))
    n, bad = baskets.agg(F.count(F.lit(1)), F.count(F.when(F.col("blocked"), True))).first()
    if bad < cfg.min_count:
        return spark.createDataFrame(
            [], "tokens array<string>, support double, confidence double, indexed string"
        )
    least = max(cfg.min_confidence, cfg.min_lift * (bad / n))
    # Half a row less, so that the product with n is not rounded up beyond min_count.
    model = FPGrowth(
        itemsCol="items", minSupport=(cfg.min_count - 0.5) / n, minConfidence=cfg.min_confidence
    ).fit(baskets.select("items"))
    single = model.freqItemsets.filter(F.size("items") == 1)
    single = single.select(F.col("items")[0].alias("token"), F.col("freq").alias("token_freq"))
    rules = model.associationRules.filter(F.array_contains("consequent", BLOCKED))
    rules = rules.filter(F.col("confidence") >= least)
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), "support", "confidence")
    each = rules.select("*", F.explode("tokens").alias("token")).join(single, "token")
    rarest = F.min(F.struct("token_freq", "token"))["token"].alias("indexed")
    return written(each.groupBy("tokens", "support", "confidence").agg(rarest), "url-rules")


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[Rule],
    cfg: MiningConfig = MiningConfig(),
    default: str = "allow",
) -> DataFrame:
    """One row per page: host, path, stated rule, verdict, and what decided it.

    ``pages`` has page_id and url, ``labels`` has doc_id (a page's id), quality
    and toxic; other columns are left alone. A page counts as blocked in the
    labels if any of its label rows is of low quality or toxic. Without a stated
    rule the strongest mined rule (confidence, support, then tokens) blocks a
    page; without one, ``default`` holds. A null url or one without ``://`` has
    no host, path or tokens and gets the default. Repeated rows are judged
    alike and all kept; a null page_id is a value like any other; an empty table
    gives no rows.
    """
    parts = url_parts(F.col("url"))
    urls = pages.select("page_id", "url").groupBy("page_id", "url").agg(
        F.count(F.lit(1)).alias("repeats")
    )
    urls = urls.select("page_id", "url", "repeats", *(c.alias(n) for n, c in parts.items()))
    names = [F.col(n) for n in ("host", "path", "query", "fragment")]
    urls = computed(urls, tokens=url_tokens(*names))
    urls = urls.select("page_id", "url", "repeats", "host", "path", "tokens")

    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("page_id"))
    marks = marks.agg(F.max(F.coalesce(bad, F.lit(False))).alias("blocked"))
    mined = mine_rules(urls.join(marks, "page_id").select("page_id", "url", "tokens", "blocked"), cfg)

    index = mined.select(
        F.col("indexed").alias("token"),
        F.col("tokens").alias("needs"),
        F.struct("confidence", "support", F.array_join("tokens", " ").alias("text")).alias("hit"),
    )
    each = urls.select("*", F.explode_outer("tokens").alias("token"))
    text_bytes = F.octet_length(F.array_join("tokens", " ")) + RULE_WIDTH
    if (mined.agg(F.sum(text_bytes)).first()[0] or 0) <= RULE_BYTES:
        hits = each.join(F.broadcast(index), "token", "left")
    else:
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))
        salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
        index = index.select("*", F.explode(salts).alias("salt"))
        hits = each.withColumn("salt", salt).join(index, ["token", "salt"], "left")
    fits_all = F.size(F.array_except("needs", "tokens")) == 0
    best = F.max(F.when(fits_all, F.col("hit"))).alias("best")
    # After a broadcast rows still lie by page_id and url, so this shuffles nothing.
    judged = hits.groupBy("page_id", "url", "repeats", "host", "path").agg(best)
    stated = stated_rule(F.col("host"), F.col("path"), rules, lambda r: r.text)
    verdict = stated_rule(F.col("host"), F.col("path"), rules, lambda r: r.verdict)
    method = F.when(F.col("best").isNotNull(), F.lit("block")).otherwise(F.lit(default))
    judged = judged.select(
        "page_id",
        "host",
        "path",
        stated.alias("rule"),
        F.coalesce(verdict, method).alias("verdict"),
        F.col("best.text").alias("mined_rule"),
        F.round("best.confidence", 6).alias("mined_confidence"),
        F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("copy"),
    )
    return judged.drop("copy")
