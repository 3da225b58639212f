"""URL filters by path-template trees: per host, variable path segments become wildcards, sibling branches whose labelled
shares don't differ statistically are merged, and templates are rejected by their smoothed labelled purity. Branches that
have no labels on their host are merged or told apart by what labels say of the same template on other hosts.
DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .line_dedup import lower_ascii
from .staging import staged

SALTS = 32  # ways that branches of one node are dealt over tasks
HOT = 256  # a key of more than one in so many rows is hot; so there are fewer than this
NODE_PATHS = 10_000  # of a node for each of these ways


def url_host(url: Column) -> Column:
    """After the first `://`, up to `/`, `?`, `#` or the end, A-Z lower-cased; empty if there is none or the url is null."""
    rest = _after_scheme(url)
    return lower_ascii(F.regexp_extract(rest, r"\A([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host, up to `?`, `#` or the end."""
    return F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(F.coalesce(at, F.lit(0)) == 0, F.lit("")).otherwise(F.substring(url, at + 3, F.length(url)))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest of `rules` (rule, verdict) that fits, as struct (rule, verdict), or null.

    A rule is a host, a `/`, and the beginning of a path; it holds for the host and all its subdomains.
    """
    fits = []
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        of, _, start = rule.partition("/")
        test = ((host == of) | host.endswith("." + of)) & path.startswith("/" + start)
        fits.append(F.when(test, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def _generalised(segment: Column) -> Column:
    """Segments that vary by their form: numbers, long hex strings, and words that hold digits."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})\z", 1)
    stem = F.substring(segment, F.lit(1), F.length(segment) - F.length(ending))
    return (
        F.when(stem.rlike(r"\A[0-9]+\z"), F.concat(F.lit("{n}"), ending))
        .when(stem.rlike(r"\A[0-9a-fA-F-]{12,}\z"), F.concat(F.lit("{x}"), ending))
        .when(stem.rlike(r"[0-9]"), F.concat(F.lit("{v}"), ending))
        .otherwise(segment)
    )


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    labels: DataFrame | None = None,
    merge_z: float = 2.0,
    prior_block: float = 0.1,
    prior_weight: float = 4.0,
    reject_share: float = 0.5,
) -> DataFrame:
    """`page_id, host, path, rule, verdict, template, template_share` for each row of `pages` (page_id, url).

    Urls under a rule take its verdict, and are the labelled ones; `labels` (host, path, bad 0/1) adds others. The tree of
    a host is made of all segments of its paths, and of as many branches as there are. Segments that vary by form become
    wildcards. Branches of one node whose shares of blocked urls lie within `merge_z` standard errors of their siblings'
    are merged to `*`; the others stay apart. A branch without labels is judged by its fellows, the labelled branches of
    the same template on other hosts, each of which counts once: it is merged to `*` unless their mean share lies
    more than `merge_z` standard errors from that of the labelled siblings' fellows. If it does, or no sibling is labelled,
    the branch stays apart, with the fellows for labels. Without fellows it goes to `*`. The tree grows level by level, as
    long as paths with labels or fellows part. A template's share is smoothed towards that of the node above,
    (blocked + prior_weight * share above) / (labelled + prior_weight), or is the share above where both have the same
    labels. Above a host is the mean of all hosts' shares, smoothed towards `prior_block` for this; so each host weighs
    the same there, and those without labels speak for the prior. Templates with a share of at least `reject_share` are
    rejected.

    Null urls and those without `://` have an empty host and path, and are judged as such. Repeated page_ids and urls are
    judged row by row. Extra columns are left out. No rows give no rows.
    """
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rows = rows.withColumn("__rule", rule_for(F.col("host"), F.col("path"), rules))
    blocked = F.when(F.col("__rule.verdict") == "block", 1).when(F.col("__rule").isNotNull(), 0)
    nodes = rows.select("*", blocked.alias("__bad"), _general_path(F.col("path")).alias("__path"))
    seen = nodes.select("host", "__path", "__bad", F.lit(1).alias("__row"))
    if labels is not None:
        seen = seen.unionByName(labels.select("host", _general_path(F.col("path")).alias("__path"), F.col("bad").alias("__bad"), F.lit(0).alias("__row")))
    n, k = F.count("__bad"), F.coalesce(F.sum("__bad"), F.lit(0))
    paths = staged(seen.groupBy("host", "__path").agg(n.alias("__n"), k.alias("__k"), F.sum("__row").alias("__rows")), "url_paths")
    smoothed = lambda k, n, above: (k + prior_weight * above) / (n + prior_weight)
    hosts = paths.groupBy("host").agg(F.sum("__n").alias("__hn"), F.sum("__k").alias("__hk"), F.count("*").alias("__size"), F.sum("__rows").alias("__rows"))
    mean = F.avg(smoothed(F.col("__hk"), F.col("__hn"), F.lit(prior_block)))
    everywhere, n_rows, n_paths = hosts.agg(F.coalesce(mean, F.lit(prior_block)), F.coalesce(F.sum("__rows"), F.lit(0)), F.coalesce(F.sum("__size"), F.lit(0))).first()
    hosts = hosts.select("host", "__size", smoothed(F.col("__hk"), F.col("__hn"), F.lit(everywhere)).alias("__share"))
    segments = F.filter(F.split("__path", "/", -1), lambda x: x != "").alias("__segments")
    tree = paths.join(hosts, "host").select("host", "__path", segments, "__n", "__k", "__rows", F.lit("").alias("__node"), "__share", "__size")
    level, done = 0, []
    while True:
        grown = staged(_grow(tree, n_paths, level, merge_z, smoothed), f"url_tree_{level}")
        done.append(grown.where("__done").select("host", "__path", "__rows", F.substring("__node", 2, 1 << 30).alias("template"), F.col("__share").alias("template_share")))
        tree, level = grown.where("NOT __done").drop("__done"), level + 1
        n_paths = tree.count()
        if n_paths == 0:
            break
    out = join_hot(nodes, reduce(DataFrame.unionByName, done), ["host", "__path"], "__rows", n_rows)
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("template_share") >= reject_share, "block"), F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("__rule.rule").alias("rule"), verdict.alias("verdict"), "template", "template_share")


def _general_path(path: Column) -> Column:
    parts = F.filter(F.split(path, "/", -1), lambda x: x != "")
    return F.coalesce(F.array_join(F.transform(parts, _generalised), "/"), F.lit(""))


def join_hot(rows: DataFrame, figures: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """`rows` with the columns of `figures` (a row for each of `keys`, which aren't null), null where there is none.

    `count` tells how many of the `total` rows have a key. Keys of more than one row in `HOT` are fewer than `HOT`: they
    are broadcast, and their rows dealt over all tasks. So no key of the other join has more than one row in `HOT`.
    """
    values = [c for c in figures.columns if c not in keys]
    packed = figures.select(*keys, F.struct(*values).alias("__figures"), (F.col(count) * HOT > total).alias("__often"))
    hot = packed.where("__often").select(*keys, F.col("__figures").alias("__hot"))
    rest = packed.where("NOT __often").select(*keys, F.lit(0).alias("__deal"), "__figures")
    dealt = F.when(F.col("__hot").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20)).cast("int"))
    met = rows.join(F.broadcast(hot), keys, "left").withColumn("__deal", dealt).join(rest, [*keys, "__deal"], "left")
    found = F.coalesce("__figures", "__hot")
    return met.select(*rows.columns, *[found[c].alias(c) for c in values if c not in rows.columns])


def _apart(k: Column, n: Column, other_k: Column, other_n: Column, z: float) -> Column:
    """Whether two shares lie more than `z` standard errors from each other; null where one has no units."""
    p = (k + other_k + 0.5) / (n + other_n + 1)
    error = F.sqrt(p * (1 - p) * (F.try_divide(F.lit(1), n) + F.try_divide(F.lit(1), other_n)))
    return F.abs(F.try_divide(k, n) - F.try_divide(other_k, other_n)) > z * error


def _grow(tree: DataFrame, n_paths: int, level: int, z: float, smoothed: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """Each of the `n_paths` paths goes on to a branch of its node, or to `*` where the branch is no different from its
    siblings together. `__done` are the paths that end there, that are alone, or that stand where neither they nor their
    fellows are labelled: no further level changes their share. `__size` is the number of a node's paths; by it a node's
    figures are dealt to its branches, so that one with very many of them doesn't fall to one task."""
    segment = F.coalesce(F.try_element_at("__segments", F.lit(level + 1)), F.lit(""))
    tree = tree.withColumn("__branch", segment)
    above = ["host", "__node"]
    branches = staged(
        tree.groupBy(*above, "__branch").agg(F.sum("__n").alias("__bn"), F.sum("__k").alias("__bk"), F.count("*").alias("__paths"), F.max("__share").alias("__above"), F.max("__size").alias("__size")),
        f"url_branches_{level}",
    )
    share = F.try_divide("__bk", "__bn")
    fellows = branches.groupBy("__node", "__branch").agg(F.count(share).alias("__fn"), F.coalesce(F.sum(share), F.lit(0.0)).alias("__fk"), F.count("*").alias("__hosts"))
    branches = join_hot(branches, fellows, ["__node", "__branch"], "__hosts", branches.count()).drop("__hosts")
    of_labelled = lambda c: F.coalesce(F.sum(F.when(F.col("__bn") > 0, F.col(c))), F.lit(0))
    node = branches.groupBy(*above).agg(
        F.sum("__bn").alias("__nn"), F.sum("__bk").alias("__nk"), of_labelled("__fn").alias("__sn"), of_labelled("__fk").alias("__sk"), F.max("__size").alias("__size")
    )
    ways = F.least(F.lit(SALTS), 1 + F.floor(F.col("__size") / NODE_PATHS)).cast("int")
    branches = branches.withColumn("__salt", F.pmod(F.xxhash64("__branch"), ways).cast("int"))
    dealt = F.explode(F.sequence(F.lit(0), ways - 1)).alias("__salt")
    rest_n, rest_k = F.col("__nn") - F.col("__bn"), F.col("__nk") - F.col("__bk")
    alone = (rest_n == 0) | _apart(F.col("__bk"), F.col("__bn"), rest_k, rest_n, z)
    by_fellows = (F.col("__fn") > 0) & ((F.col("__sn") == 0) | _apart(F.col("__fk"), F.col("__fn"), F.col("__sk"), F.col("__sn"), z))
    stays = F.coalesce(F.when(F.col("__bn") > 0, alone).otherwise(by_fellows), F.lit(False))
    name = F.when(F.col("__branch") == "", "").when(stays, F.col("__branch")).otherwise("*")
    fellow = lambda c: F.when((F.col("__bn") == 0) & by_fellows, F.col(c)).otherwise(0).alias(c)
    named = branches.join(node.select(*above, "__nn", "__nk", "__sn", "__sk", dealt), [*above, "__salt"])
    named = named.select(*above, "__branch", "__salt", "__bn", "__bk", "__paths", "__above", "__size", "__nn", name.alias("__name"), fellow("__fn"), fellow("__fk"))
    named = staged(named, f"url_named_{level}")
    kept = (
        F.when(F.col("__fn") > 0, smoothed(F.col("__fk"), F.col("__fn"), F.col("__above")))
        .when(F.col("__cn") == F.col("__nn"), F.col("__above"))
        .otherwise(smoothed(F.col("__ck"), F.col("__cn"), F.col("__above")))
    )
    pooled = named.groupBy(*above, "__name").agg(
        F.sum("__bn").alias("__cn"), F.sum("__bk").alias("__ck"), F.sum("__paths").alias("__cp"), F.max("__above").alias("__above"), F.max("__nn").alias("__nn"), F.max("__size").alias("__size"),
        F.max("__fn").alias("__fn"), F.max("__fk").alias("__fk"),
    )
    pooled = pooled.select(*above, "__name", "__cn", "__cp", "__fn", kept.alias("__new"), dealt)
    named = named.select(*above, "__branch", "__name", "__salt", "__paths").join(pooled, [*above, "__name", "__salt"]).drop("__salt")
    joined = join_hot(tree, named, [*above, "__branch"], "__paths", n_paths)
    done = (F.col("__branch") == "") | (F.col("__cp") == 1) | ((F.col("__cn") == 0) & (F.col("__fn") == 0))
    rest = F.slice("__segments", F.lit(level + 2), F.greatest(F.size("__segments") - (level + 1), F.lit(0)))
    rest = F.when(F.col("__cn") > 0, rest).otherwise(F.transform(rest, lambda x: F.lit("*")))
    names = F.when(F.col("__branch") == "", F.array().cast("array<string>")).otherwise(F.concat(F.array("__name"), F.when(done, rest).otherwise(F.array().cast("array<string>"))))
    node_name = F.concat("__node", F.array_join(F.transform(names, lambda x: F.concat(F.lit("/"), x)), ""))
    return joined.select("host", "__path", "__segments", "__n", "__k", "__rows", node_name.alias("__node"), F.col("__new").alias("__share"), F.col("__cp").alias("__size"), done.alias("__done"))
