"""Pair similarities. Both empty: 1; one empty: 0. Set measures and Levenshtein are built-in expressions; the Indel family
has no built-in and runs once for each pair in one Arrow pass."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def guarded(a: Column, b: Column, value: Column) -> Column:
    return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(value)


def jaccard(a: Column, b: Column) -> Column:
    """Of arrays of distinct values."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def levenshtein_similarity(a: Column, b: Column) -> Column:
    return guarded(a, b, 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def gram_jaccard(a: Column, b: Column, grams_a: Column, grams_b: Column, n: int) -> Column:
    """As `jaccard`, but equality where either text is shorter than n."""
    return F.when((F.length(a) < n) | (F.length(b) < n), (a == b).cast("double")).otherwise(jaccard(grams_a, grams_b))


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel: a bit of `row` is clear where the length grows."""
    if len(a) > len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel(a: str, b: str) -> float:
    if not a and not b:
        return 1.0
    return 2 * common(a, b) / (len(a) + len(b)) if a and b else 0.0


def token_sort(a: str, b: str) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Best of: common tokens against common and own ones of either side, and both sides against each other."""
    if not a and not b:
        return 1.0
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 1.0
    one, two = (" ".join(sorted(s)) for s in (x - y, y - x))
    with_one, with_two = (f"{both} {s}".strip() for s in (one, two))
    best = indel(with_one, with_two)
    if both:
        best = max(best, indel(both, with_one), indel(both, with_two))
    return best


def partial(a: str, b: str) -> float:
    """Best Indel similarity of the shorter text with a window of the longer one, cut windows at both ends too."""
    if not a or not b:
        return float(not a and not b)
    if len(a) > len(b):
        a, b = b, a
    if a in b:
        return 1.0
    n = len(a)
    windows = {b[max(0, i) : i + n] for i in range(1 - n, len(b))}
    return max(indel(a, w) for w in windows)


def weighted(a: str, b: str) -> float:
    """Whole texts where lengths are alike; partial ones, scaled down, where they are not."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    ratio = max(len(a), len(b)) / min(len(a), len(b))
    if ratio < 1.5:
        return max(indel(a, b), 0.95 * token_sort(a, b), 0.95 * token_set(a, b))
    scale = 0.9 if ratio <= 8 else 0.6
    x, y = set(a.split()), set(b.split())
    sides = partial(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    sets = 1.0 if x & y else partial(" ".join(sorted(x - y)), " ".join(sorted(y - x)))
    return max(indel(a, b), scale * partial(a, b), 0.95 * scale * max(sides, sets))


#: Columns of the pass: what is compared, and by what.
INDEL_FEATURES = {
    "name_levenshtein_ratio": ("n1", "n2", indel), "name_token_sort_ratio": ("n1", "n2", token_sort), "name_token_set_ratio": ("n1", "n2", token_set), "name_w_ratio": ("n1", "n2", weighted),
    "name_translit_levenshtein_ratio": ("n1", "t2", indel), "name_translit_token_sort_ratio": ("n1", "t2", token_sort), "name_translit_token_set_ratio": ("n1", "t2", token_set), "name_translit_w_ratio": ("n1", "t2", weighted),
    "address_levenshtein_ratio": ("a1", "a2", indel), "address_token_set_ratio": ("a1", "a2", token_set),
}


@F.pandas_udf(T.StructType([T.StructField(k, T.DoubleType()) for k in INDEL_FEATURES]))
def indel_features(columns: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """(n1, n2, t2, a1, a2) -> all Indel similarities of a pair. The transliterated name is compared only where it differs."""
    for n1, n2, t2, a1, a2 in columns:
        by = {"n1": n1, "n2": n2, "t2": t2, "a1": a1, "a2": a2}
        out = {}
        for name, (x, y, f) in INDEL_FEATURES.items():
            if y == "t2":
                known = out[name.replace("translit_", "")]
                out[name] = [k if same else f(p, q) for k, same, p, q in zip(known, n2 == t2, by[x], by[y], strict=True)]
            else:
                out[name] = [f(p, q) for p, q in zip(by[x], by[y], strict=True)]
        yield pd.DataFrame(out)


indel_ratio = F.pandas_udf(lambda a, b: pd.Series([indel(x, y) for x, y in zip(a, b, strict=True)]), T.DoubleType())
token_sort_ratio = F.pandas_udf(lambda a, b: pd.Series([token_sort(x, y) for x, y in zip(a, b, strict=True)]), T.DoubleType())
token_set_ratio = F.pandas_udf(lambda a, b: pd.Series([token_set(x, y) for x, y in zip(a, b, strict=True)]), T.DoubleType())
w_ratio = F.pandas_udf(lambda a, b: pd.Series([weighted(x, y) for x, y in zip(a, b, strict=True)]), T.DoubleType())


def register(spark) -> None:
    """The Python similarities and the transliteration for SQL."""
    from .text import _latin

    for name, f in {"indel_ratio": indel_ratio, "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio, "w_ratio": w_ratio, "transliterate": _latin}.items():
        spark.udf.register(name, f)
