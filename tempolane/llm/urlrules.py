"""URL filter: host/path rules first, then pattern rules found by a literal token.

A pattern rule is a regular expression together with the literal tokens that any
url matching it must contain whole: what the pattern bounds on either side. Rules are indexed by the one of their tokens that
the fewest urls hold; a url fetches the rules of its own tokens, and only those
run. The rule tables are parameters, held within `MAX_RULES`, and so may be
broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempolane.llm.text import UPPER, free_name

MAX_RULES = 50_000

# The base rules as (host, path, verdict).
BASE_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
# (pattern on the lower-cased url, tokens that it needs, verdict)
PATTERN_RULES = (
    (r"(^|[./-])casino-[a-z]+\.", ("casino",), "block"),
    (r"(^|[./-])[a-z]+-casino\.", ("casino",), "block"),
    (r"(^|[./-])cheap-pills\.", ("cheap", "pills"), "block"),
    (r"(^|[./-])free-bets\.", ("free", "bets"), "block"),
    (r"(^|[./-])spam-farm\.", ("spam", "farm"), "block"),
    (r"(^|[./-])ads?-track\.", ("track",), "block"),
    (r"(^|[./-])ads?-tracker\.", ("tracker",), "block"),
    (r"(^|[./-])ads?-tracking\.", ("tracking",), "block"),
    (r"[?&]utm_source=feed(&|#|$)", ("utm", "source", "feed"), "allow"),
    (r"/wp-login\.php", ("wp", "login"), "block"),  # php may go on
    (r"/(porn|xxx)/", (), "block"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty without `://`."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _suffixes(host: Column) -> Column:
    """a.b.c: [a.b.c, b.c, c]."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(url, F.lit("[a-z0-9]+"), 0))


def host_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting host/path rule, or null.

    The rules are looked up by the suffixes of the host, so the work for a url
    follows its labels and not the number of rules.
    """
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for h, p, verdict in rules:
        by_host.setdefault(h, []).append((p, h + p, verdict))
    pairs = []
    for h, found in by_host.items():
        pairs += [
            F.lit(h),
            F.array(*[F.struct(F.lit(len(r)).alias("n"), F.lit(p).alias("p"), F.lit(r).alias("rule"),
                               F.lit(v).alias("verdict")) for p, r, v in found]),
        ]
    table = F.create_map(*pairs)
    hits = F.flatten(F.filter(F.transform(_suffixes(host), lambda s: F.element_at(table, s)), lambda x: x.isNotNull()))
    best = F.array_max(F.filter(hits, lambda x: F.startswith(path, x["p"])))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def token_index(urls: DataFrame, url: Column, patterns) -> list[tuple[int, str | None, str, str]]:
    """(number, rarest literal token or None, pattern, verdict). Token counts are
    taken over all urls; the rules' own tokens are the only ones counted."""
    wanted = sorted({t for _, tokens, _ in patterns for t in tokens})
    counts: dict[str, int] = {}
    if wanted:
        lowered = F.translate(F.coalesce(url, F.lit("")), UPPER, UPPER.lower())
        found = (
            urls.select(F.explode(F.array_intersect(_tokens(lowered), F.array(*map(F.lit, wanted)))).alias("t"))
            .groupBy("t")
            .count()
            .collect()  # a row for each token of the rules at most
        )
        counts = {r["t"]: r["count"] for r in found}
    return [
        (i, min(tokens, key=lambda t: (counts.get(t, 0), t)) if tokens else None, pattern, verdict)
        for i, (pattern, tokens, verdict) in enumerate(patterns)
    ]


def judge_urls(
    urls: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = BASE_RULES,
    patterns=PATTERN_RULES,
    default: str = "allow",
) -> DataFrame:
    """`urls` with host, path, rule and verdict.

    A host/path rule that fits gives the verdict, the longest first. Otherwise
    the fitting pattern rule that stands first does, and `default` where none
    fits. A null or empty url, or one without `://`, has empty host and path and
    can only meet pattern rules (a null url meets none). Repeated rows are judged
    one by one. Columns of the names host, path, rule and verdict are replaced;
    any others are kept.
    """
    if len(rules) + len(patterns) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    kept = [c for c in urls.columns if c.lower() not in {"host", "path", "rule", "verdict"} or c == url]
    index = token_index(urls, F.col(f"`{url}`"), patterns)
    low, parts, hit = (free_name(urls.columns, n) for n in ("low_url", "url_parts", "rule_hit"))
    host, path = split_url(F.col(f"`{url}`"))
    rows = urls.select(*[F.col(f"`{c}`") for c in kept], F.struct(host.alias("host"), path.alias("path")).alias(parts))
    rows = rows.withColumn(hit, host_rule(F.col(parts)["host"], F.col(parts)["path"], rules))
    rows = rows.withColumn(low, F.translate(F.coalesce(F.col(f"`{url}`"), F.lit("")), UPPER, UPPER.lower()))

    by_token: dict[str, list] = {}
    for i, token, pattern, verdict in index:
        if token is not None:
            by_token.setdefault(token, []).append(
                F.struct(F.lit(i).alias("i"), F.lit(pattern).alias("pattern"), F.lit(verdict).alias("verdict"))
            )
    always = [
        F.struct(F.lit(i).alias("i"), F.lit(pattern).alias("pattern"), F.lit(verdict).alias("verdict"))
        for i, token, pattern, verdict in index
        if token is None
    ]
    none = F.array().cast("array<struct<i:int,pattern:string,verdict:string>>")
    fetched = F.array(*always) if always else none
    if by_token:
        table = F.create_map(*[x for t, found in by_token.items() for x in (F.lit(t), F.array(*found))])
        own = F.flatten(
            F.filter(F.transform(_tokens(F.col(low)), lambda t: F.element_at(table, t)), lambda x: x.isNotNull())
        )
        fetched = F.concat(fetched, own)
    first = F.array_min(F.filter(fetched, lambda r: F.rlike(F.col(low), r["pattern"])))
    verdict = (
        F.when(F.col(hit).isNotNull(), F.col(hit)["verdict"])
        .when(F.col(f"`{url}`").isNull(), F.lit(default))
        .otherwise(F.coalesce(first["verdict"], F.lit(default)))
    )
    return rows.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col(parts)["host"].alias("host"),
        F.col(parts)["path"].alias("path"),
        F.col(hit)["rule"].alias("rule"),
        verdict.alias("verdict"),
    )
