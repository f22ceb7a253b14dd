"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over ``host + path`` with a verdict. Three kinds exist:
``host/path`` rules fit a host, its subdomains, and paths that start with the
rule's path; ``word`` rules fit a word (letters and digits between other
characters) anywhere in the host. A table of ``patterns`` adds rules of any number:
``*`` stands for any characters, ``^`` for a separator (no letter, digit, ``_``,
``.``, ``%`` or ``-``) or the end, ``|`` at an end of the pattern for that
end of ``host + path``, ``||`` at its start for the start of the host or of a name in
it; all else is literal, and A-Z count as a-z. Every rule has literal tokens, runs of a-z
and 0-9. A rule is indexed by the whole token, one that no letter or digit can
follow in a fitting url, that occurs in the fewest distinct urls of the table;
the last token of a path without a separator at its end isn't whole (``/fr``
fits ``/france``). A rule without a whole token runs on every url. The tokens of a url fetch its candidate rules, and only those run
their regular expressions. Among the fitting rules host/path rules come
first, then the longest wins (ties: the smaller text); without a fit the
verdict is ``allow``.

Only DataFrame functions are used. Scale: each distinct url is judged once, so
a hot url costs one row; its rows meet the verdict in a join on the url that
Spark may split. The rules are broadcast up to ``BROADCAST_RULES``, else joined
by a shuffle on the token.

Cases: a null url or one without ``://`` has empty host and path and no rule;
repeated rows are judged each; other columns are not read; an empty table
gives an empty result; a listed rule without a literal token is refused. Null and
empty patterns are no rules, repeated ones are one; a pattern with a null verdict
blocks; of one pattern with both verdicts the greater text (block) holds.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.common import written

BROADCAST_RULES = 100_000
BROADCAST_BYTES = 32 << 20
# the token of rules without a whole one; every url has it then
ANY = "*"

# (host, path, verdict), as the contract lists them
SITE_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
              ("net", "/es/", "block"), ("net", "/fr/", "block")]
# words of host names that commonly mark advertising, gambling, pill shops and adult sites
WORD_RULES = ["ads", "adult", "bets", "casino", "pills", "porn", "spam", "xxx"]


def _lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return _lowered(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text)


def _compiled(sites: Sequence[tuple[str, str, str]], words: Sequence[str]) -> list[tuple[int, str, str, str, list[str]]]:
    """(kind, rule, verdict, regular expression, tokens); kind 1 goes before 0."""
    rules = [(1, host + path, verdict, f"^([^/]*\\.)?{_quoted(host + path)}", host + path) for host, path, verdict in sites]
    rules += [(0, word, "block", f"^([^/]*[^a-z0-9/])?{_quoted(word)}([^a-z0-9]|$)", word) for word in words]
    out = []
    for kind, rule, verdict, regex, text in rules:
        text = text.lower()
        if not re.search("[a-z0-9]", text):
            raise ValueError(f"rule {rule!r} has no literal token")
        # a site rule fits by prefix: what its text ends inside of isn't a whole token of the url
        whole = re.findall("[a-z0-9]+(?=[^a-z0-9])" if kind == 1 else "[a-z0-9]+", text)
        out.append((kind, rule, verdict, regex, sorted(set(whole)) or [ANY]))
    return out


def _listed(spark: SparkSession, sites: Sequence[tuple[str, str, str]], words: Sequence[str]) -> DataFrame | None:
    """The rules given as lists: kind, rule, verdict, regular expression and tokens."""
    compiled = _compiled(sites, words)
    if not compiled:
        return None
    literal = F.array(*[F.struct(F.lit(k).alias("__kind"), F.lit(r).alias("__rule"), F.lit(v).alias("__verdict"),
                                 F.lit(x).alias("__regex"), F.array(*map(F.lit, t)).alias("__tokens"))
                        for k, r, v, x, t in compiled])
    return spark.range(1).select(F.explode(literal).alias("r")).select("r.*")


def compile_patterns(patterns: DataFrame) -> DataFrame:
    """The same columns from a table of patterns (columns ``pattern``, ``verdict``)."""
    text = F.col("__rule")
    body = F.regexp_replace(F.regexp_replace(text, r"^\|\|?", ""), r"\|$", "")
    regex = F.regexp_replace(body, r"([^a-z0-9*^])", r"\\$1")
    regex = F.replace(F.replace(regex, F.lit("^"), F.lit(r"([^a-z0-9_.%-]|$)")), F.lit("*"), F.lit(".*"))
    start = F.when(text.startswith("||"), r"^([^/]*\.)?").when(text.startswith("|"), "^").otherwise("")
    end = F.when(F.length(text) > 1, F.when(text.endswith("|"), "$")).otherwise(None)
    # whole tokens: a literal character, an anchor or a separator stands on either side
    tokens = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?<=[^a-z0-9*])([a-z0-9]+)(?=[^a-z0-9*])"), F.lit(1)))
    return (patterns.select(_lowered(F.col("pattern").cast("string")).alias("__rule"),
                            F.coalesce(F.col("verdict").cast("string"), F.lit("block")).alias("__verdict"))
            .where(F.length(body) > 0).groupBy("__rule").agg(F.max("__verdict").alias("__verdict"))
            .select(F.lit(0).alias("__kind"), "__rule", "__verdict",
                    F.concat(F.lit("(?s)"), start, regex, F.coalesce(end, F.lit(""))).alias("__regex"),
                    F.when(F.size(tokens) > 0, tokens).otherwise(F.array(F.lit(ANY))).alias("__tokens")))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", *,
          sites: Sequence[tuple[str, str, str]] = SITE_RULES, words: Sequence[str] = WORD_RULES,
          patterns: DataFrame | None = None) -> DataFrame:
    """Per row: id, host, path, ``rule`` (the winning host/path rule), ``pattern``
    (any winning rule) and ``verdict``."""
    rules = _listed(pages.sparkSession, sites, words)
    small = F.broadcast
    if patterns is not None:
        table = written(compile_patterns(patterns), "rules")
        size = table.agg(F.count("*"), F.coalesce(F.sum(F.length("__rule") + F.length("__regex")), F.lit(0))).first()
        if size[0] > BROADCAST_RULES or size[1] > BROADCAST_BYTES:
            small = lambda rows: rows
        rules = table if rules is None else rules.unionByName(table)
    rows = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("__url"))
    urls = (rows.select("__url").where("__url is not null").distinct()
            .select("__url", F.concat(host_of(F.col("__url")), path_of(F.col("__url"))).alias("__place")))
    if rules is None:
        best = urls.select("__url", F.lit(None).cast("struct<k:int,n:int,rule:string,verdict:string>").alias("__best"))
    else:
        tokens = rules.select("__kind", "__rule", F.explode("__tokens").alias("__token"))
        held = F.array_distinct(F.split(F.lower("__place"), "[^a-z0-9]+"))
        if patterns is not None or any(ANY in tokens for *_, tokens in _compiled(sites, words)):
            held = F.array_append(held, F.lit(ANY))
        found = urls.select("__url", "__place", F.explode(held).alias("__token"))
        seen = (found.join(small(tokens.select("__token").distinct()), "__token")
                .groupBy("__token").agg(F.count("*").alias("__urls")))
        rarest = (tokens.join(seen, "__token", "left").groupBy("__kind", "__rule")
                  .agg(F.min(F.struct(F.coalesce("__urls", F.lit(0)), "__token")).alias("t"))
                  .select("__kind", "__rule", F.col("t.__token").alias("__token")))
        index = rules.join(rarest, ["__kind", "__rule"]).drop("__tokens")
        place = F.when(F.col("__kind") == 0, _lowered(F.col("__place"))).otherwise(F.col("__place"))
        fits = found.join(small(index), "__token").withColumn("__seen", place).where(F.expr("__seen rlike __regex"))
        best = fits.groupBy("__url").agg(F.max(F.struct(
            F.col("__kind").alias("k"), F.length("__rule").alias("n"), F.col("__rule").alias("rule"),
            F.col("__verdict").alias("verdict"))).alias("__best"))
    url = F.col("__url")
    return rows.join(best, "__url", "left").select(
        id_col, host_of(url).alias("host"), path_of(url).alias("path"),
        F.when(F.col("__best.k") == 1, F.col("__best.rule")).alias("rule"), F.col("__best.rule").alias("pattern"),
        F.coalesce("__best.verdict", F.lit("allow")).alias("verdict"))
