"""URL filter by a weighted vocabulary (operator 4).

One Aho-Corasick automaton holds all terms; one pass over a lower-cased (A-Z) url finds every occurrence. An occurrence
counts only where no ASCII letter or digit stands next to it. A url is blocked on one strict term, or on `min_hits`
distinct soft terms that weigh `min_weight` together. The vocabulary is a parameter: terms with weights. Host and path rules come before: the longest rule that fits decides.

Defined results: a null url, and one without `://`, has empty host and path, fits no rule; a null url has no terms and is
allowed. Repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The vocabulary of the registered query. Terms by weight; a soft term of weight 2 is a plainer sign than one
# of weight 1.
STRICT = (
    "porn porno pornhub xxx sexcam sexcams camgirl camgirls hentai nsfw nude nudes milf hardcore escort escorts stripper striptease erotica fetish bdsm "
    "casino casinos gambling sportsbook roulette blackjack baccarat viagra cialis levitra xanax oxycontin tramadol steroids "
    "malware phishing ransomware keylogger trojan spyware botnet warez keygen crackz torrentz payday counterfeit"
).split()
SOFT = {
    2: "adult bet bets betting bingo jackpot lottery lotto poker slot slots wager sexy dating hookup singles pharma pharmacy pill pills replica replicas loan loans forex crypto crack cracked torrent torrents pirate spam clickbait affiliate doorway linkfarm spin",
    1: "ad ads advert banner bonus buy cash cheap cheapest click clicks coupon coupons deal deals discount earn easy exclusive farm fast free freebie gift gifts guaranteed hot instant limited money offer offers outlet popup popups prize prizes profit promo promos rich sale sales sponsored sweepstakes track tracker tracking traffic trial unlimited vip viral voucher win winner winners winning",
}
VOCABULARY = tuple((t, 0) for t in STRICT) + tuple((t, weight) for weight, terms in SOFT.items() for t in terms.split())
MIN_HITS, MIN_WEIGHT = 2, 3  # distinct soft terms that reject a url, and what they have to weigh together
MOST_TERMS = 1_000_000  # an automaton goes to every task

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")


@functools.lru_cache(4)
def automaton(vocabulary: tuple[tuple[str, int], ...]) -> ahocorasick.Automaton:
    """Of (term, weight); weight 0 is strict. A term that is listed twice is strict, or has its greater weight."""
    best: dict[str, int] = {}
    for term, weight in vocabulary:
        best[term] = weight if term not in best else 0 if 0 in (weight, best[term]) else max(weight, best[term])
    out = ahocorasick.Automaton()
    for term, weight in best.items():
        out.add_word(term, (weight, term))
    out.make_automaton()
    return out


def hits(url: str | None, vocabulary: tuple[tuple[str, int], ...]) -> tuple[int, int, int]:
    """Numbers of distinct strict and soft terms in the url, and the weight of the soft ones."""
    if not url or not vocabulary:
        return 0, 0, 0
    text = url.translate(_LOWERED)
    found: set[tuple[int, str]] = set()
    for end, hit in automaton(vocabulary).iter(text):
        start = end - len(hit[1]) + 1
        if (start == 0 or text[start - 1] not in _WORD) and (end + 1 == len(text) or text[end + 1] not in _WORD):
            found.add(hit)
    soft = [weight for weight, _ in found if weight]
    return len(found) - len(soft), len(soft), sum(soft)


def read_vocabulary(terms: DataFrame) -> tuple[tuple[str, int], ...]:
    """The vocabulary of a table (term string, weight int; weight 0 is strict), lower-cased; at most MOST_TERMS terms."""
    rows = terms.select(F.translate(F.trim("term"), UPPER, LOWER).alias("term"), F.col("weight").cast("int").alias("weight")).where("term <> '' and weight >= 0").distinct().limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"the vocabulary has more than {MOST_TERMS} terms")
    return tuple(sorted((r["term"], r["weight"]) for r in rows))


_LOWERED = str.maketrans(UPPER, LOWER)
_WORD = frozenset(map(chr, ALNUM))


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: str, host: Column, path: Column) -> Column:
    at = rule.index("/")
    name, prefix = rule[:at], rule[at:]
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], vocabulary: Sequence[tuple[str, int]] = VOCABULARY, min_hits: int = MIN_HITS, min_weight: int = MIN_WEIGHT, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule (null where none fits), verdict (allow or block), strict_terms, soft_terms, soft_weight.

    rules: (verdict, rule) with a rule written as host and path, like ("allow", "org/"). vocabulary: (term, weight) in lower
    case, weight 0 for strict terms (see `read_vocabulary` for one in a table).
    """
    shared = pages.sparkSession.sparkContext.broadcast(tuple(map(tuple, vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [hits(u, shared.value) for u in b.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array([x[k] for x in found], pa.int32()) for k in range(3))], [*b.schema.names, *counts])

    counts = ["strict_terms", "soft_terms", "soft_weight"]
    url = pages[url_col].cast("string")
    found = pages.select(pages[id_col].alias("id"), url.alias("url"), url_host(url).alias("host"), url_path(url).alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.when((F.col("strict_terms") > 0) | ((F.col("soft_terms") >= min_hits) & (F.col("soft_weight") >= min_weight)), "block").otherwise("allow")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is tested first, as it is wrapped last
        fit = fits(text, F.col("host"), F.col("path"))
        rule, verdict = F.when(fit, F.lit(text)).otherwise(rule), F.when(fit, F.lit(kind)).otherwise(verdict)
    key = pages.schema[id_col].dataType.simpleString()
    counted = found.mapInArrow(run, f"id {key}, url string, host string, path string, strict_terms int, soft_terms int, soft_weight int")
    return counted.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), verdict.alias("verdict"), *counts)


def sql(rules: Sequence[tuple[str, str]]) -> str:
    """The registered query for DuckDB: a url is split into runs of letters and digits, which are looked up in the terms."""
    cases = lambda value: " ".join(f"when (host = '{r[: r.index('/')]}' or host like '%.{r[: r.index('/')]}') and starts_with(path, '{r[r.index('/') :]}') then {value(k, r)}" for k, r in sorted(rules, key=lambda r: -len(r[1])))
    terms = ", ".join(f"('{t}', {w})" for t, w in VOCABULARY)
    return f"""with terms(term, weight) as (values {terms}),
parts as (
  select page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
seen as (select distinct url, unnest(regexp_extract_all(translate(url, '{UPPER}', '{LOWER}'), '[a-z0-9]+')) as term from pages),
sums as (select url, sum((weight = 0)::int)::int as strict_terms, sum((weight > 0)::int)::int as soft_terms, sum(weight)::int as soft_weight from seen join terms using (term) group by all),
counted as (select parts.*, coalesce(strict_terms, 0) as strict_terms, coalesce(soft_terms, 0) as soft_terms, coalesce(soft_weight, 0) as soft_weight from parts left join sums using (url))
select page_id, host, path, case {cases(lambda k, r: f"'{r}'")} end as rule,
  case {cases(lambda k, r: f"'{k}'")} when strict_terms > 0 or (soft_terms >= {MIN_HITS} and soft_weight >= {MIN_WEIGHT}) then 'block' else 'allow' end as verdict,
  strict_terms, soft_terms, soft_weight
from counted"""
