"""The costly pair similarities of many pairs at once (numpy): the same values as `similarity` gives pair by pair.

Longest common subsequences and Levenshtein distances are bit-parallel with a machine word for each pair, so the shorter text
has at most WORD characters; other pairs go to the plain functions one by one. Sets of n-grams and tokens are rows of sorted
integers, exact ones; what two rows have in common are the neighbours of equal value once both are sorted into one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd

from . import similarity as S

WORD, WIDE, ROWS = 64, 256, 4096


def lengths(texts: Sequence[str]) -> np.ndarray:
    return np.fromiter(map(len, texts), np.int64, len(texts))


def by_width(width: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the pairs, the widest ones first, a few thousand at a time: a matrix is as wide as its longest text."""
    order = np.argsort(-width, kind="stable")
    for start in range(0, len(order), ROWS):
        yield order[start : start + ROWS]


def matrix(texts: list[str], width: int) -> np.ndarray:
    """Code points, 0 after the end."""
    return np.array(texts, dtype=f"U{max(width, 1)}").view(np.uint32).reshape(len(texts), max(width, 1))


def alphabet(*tables: np.ndarray) -> tuple[list[np.ndarray], int]:
    """The tables with small codes instead of code points, and the number of codes; 0 stays 0."""
    seen = np.zeros(max(int(t.max(initial=0)) for t in tables) + 1, bool)
    seen[0] = True
    for t in tables:
        seen[t] = True
    code = np.cumsum(seen) - 1
    return [code[t] for t in tables], int(code[-1]) + 1


def places(a: np.ndarray, codes: int) -> np.ndarray:
    """For each row and code a word with the places of the code, as one flat table."""
    out, base = np.zeros(len(a) * codes, np.uint64), np.arange(len(a)) * codes
    for i in range(a.shape[1]):
        out[base + a[:, i]] |= np.uint64(1 << i)
    return out


def levenshtein(a: str, b: str) -> int:
    """As `F.levenshtein`, bit-parallel over an integer of any size."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = full, 0, len(a)
    for c in b:
        eq = at.get(c, 0)
        xv, xh = eq | down, (((eq & up) + up) ^ up) | eq
        ph, mh = down | (full & ~(xh | up)), up & xh
        score += bool(ph & last) - bool(mh & last)
        ph, mh = (ph << 1) | 1, mh << 1
        up, down = (mh | (full & ~(xv | ph))) & full, ph & xv & full
    return score


def distances(a: list[str], b: list[str], edits: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Longest common subsequences, and Levenshtein distances where wanted (else zeros)."""
    la, lb = lengths(a), lengths(b)
    lcs, lev = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    less, most = np.minimum(la, lb), np.maximum(la, lb)
    lev[less == 0] = most[less == 0]
    for i in np.flatnonzero((less > WORD) | (most > WIDE)).tolist():
        lcs[i] = S.common(a[i], b[i])
        if edits:
            lev[i] = levenshtein(a[i], b[i])
    some = np.flatnonzero((less > 0) & (less <= WORD) & (most <= WIDE))
    for part in by_width(most[some]):
        at = some[part]
        pairs = [(a[i], b[i]) if la[i] <= lb[i] else (b[i], a[i]) for i in at.tolist()]
        n, m = less[at], most[at]
        (x, y), codes = alphabet(matrix([p for p, _ in pairs], int(n.max())), matrix([q for _, q in pairs], int(m.max())))
        table, base = places(x, codes), np.arange(len(at)) * codes
        active = np.searchsorted(-m, -np.arange(y.shape[1]), "left").tolist()  # m falls: rows that have a character at j
        one = np.uint64(1)
        full = np.where(n == WORD, ~np.uint64(0), (one << (n % WORD).astype(np.uint64)) - one)
        row = np.full(len(at), ~np.uint64(0))
        up, down, score, last = row.copy(), np.zeros(len(at), np.uint64), n.copy(), one << (n - 1).astype(np.uint64)
        for j, k in enumerate(active):
            eq = table[base[:k] + y[:k, j]]
            r = row[:k]
            hit = r & eq
            row[:k] = (r + hit) | (r - hit)
            if edits:
                pv, mv = up[:k], down[:k]
                xv, xh = eq | mv, (((eq & pv) + pv) ^ pv) | eq
                ph, mh = mv | ~(xh | pv), pv & xh
                score[:k] += ((ph & last[:k]) != 0).astype(np.int64) - ((mh & last[:k]) != 0)
                ph, mh = (ph << one) | one, mh << one
                up[:k], down[:k] = mh | ~(xv | ph), ph & xv
        lcs[at] = n - np.bitwise_count(row & full)
        lev[at] = score
    return lcs, lev


def indels(a: list[str], b: list[str], lcs: np.ndarray) -> np.ndarray:
    la, lb = lengths(a), lengths(b)
    return np.where(la + lb == 0, 1.0, 2 * lcs / np.maximum(la + lb, 1))


def edit_similarity(a: list[str], b: list[str], lev: np.ndarray) -> np.ndarray:
    la, lb = lengths(a), lengths(b)
    return np.where((la == 0) & (lb == 0), 1.0, np.where((la == 0) | (lb == 0), 0.0, 1 - lev / np.maximum(np.maximum(la, lb), 1)))


def partials(a: list[str], b: list[str]) -> np.ndarray:
    """`similarity.partial` of texts that are not empty."""
    out = np.zeros(len(a))
    pairs = [(p, q) if len(p) <= len(q) else (q, p) for p, q in zip(a, b, strict=True)]
    rest = []
    for i, (p, q) in enumerate(pairs):
        if p in q:
            out[i] = 1.0
        elif len(p) > WORD or len(q) > WIDE:
            out[i] = S.partial(p, q)
        else:
            rest.append(i)
    for start in range(0, len(rest), 1024):
        at = rest[start : start + 1024]
        short, long = [pairs[i][0] for i in at], [pairs[i][1] for i in at]
        n, m = lengths(short), lengths(long)
        (x, y), codes = alphabet(matrix(short, int(n.max())), matrix(long, int(m.max())))
        table, count = places(x, codes), n + m - 1
        ends = np.cumsum(count)
        pair = np.repeat(np.arange(len(at)), count)
        first = np.arange(ends[-1]) - np.repeat(ends - count, count) + 1 - n[pair]
        begin, size = np.maximum(first, 0), np.minimum(m[pair], first + n[pair]) - np.maximum(first, 0)
        order = np.argsort(-size, kind="stable")
        row = np.full(len(order), ~np.uint64(0))
        base, text = pair[order] * codes, pair[order] * y.shape[1] + begin[order]
        flat = y.ravel()
        for j, k in enumerate(np.searchsorted(-size[order], -np.arange(int(size.max())), "left").tolist()):
            r = row[:k]
            hit = r & table[base[:k] + flat[text[:k] + j]]
            row[:k] = (r + hit) | (r - hit)
        one = np.uint64(1)
        full = np.where(n == WORD, ~np.uint64(0), (one << (n % WORD).astype(np.uint64)) - one)
        value = np.empty(len(order))
        value[order] = 2 * (n[pair[order]] - np.bitwise_count(row & full[pair[order]])) / (n[pair] + size)[order]
        out[at] = np.maximum.reduceat(value, ends - count)
    return out


def distinct_rows(table: np.ndarray) -> np.ndarray:
    """Rows sorted, each value once; what is left out is -1."""
    table.sort(axis=1)
    table[:, 1:][table[:, 1:] == table[:, :-1]] = -1
    return table


def shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of values (not negative) that the rows of two tables of distinct values have in common."""
    both = np.concatenate([x, y], axis=1)
    both.sort(axis=1)
    return ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] >= 0)).sum(1)


def gram_set(t: str, n: int) -> set[str]:
    return {t[i : i + n] for i in range(len(t) - n + 1)} if len(t) >= n else {t} - {""}


def jaccards(inter: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    union = x + y - inter
    return np.where(union == 0, 1.0, inter / np.maximum(union, 1))


def gram_jaccards(a: list[str], b: list[str], sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Jaccard similarities of the sets of n-grams (`text.char_ngrams`), for each size."""
    out = [np.zeros(len(a)) for _ in sizes]
    la, lb = lengths(a), lengths(b)
    most = np.maximum(la, lb)
    for part in by_width(most):
        width = int(most[part].max(initial=0))
        texts = [[side[i] for i in part.tolist()] for side in (a, b)]
        (x, y), codes = alphabet(*(matrix(t, width) for t in texts)) if width <= WIDE else ((None, None), 0)
        for n, values in zip(sizes, out, strict=True):
            if x is None or codes**n >= 1 << 62:
                sets = [(gram_set(p, n), gram_set(q, n)) for p, q in zip(*texts, strict=True)]
                values[part] = [len(p & q) / len(p | q) if p or q else 1.0 for p, q in sets]
                continue
            kind, rows = np.int32 if codes**n < 1 << 31 else np.int64, []
            for table, length in ((x, la[part]), (y, lb[part])):
                padded = np.pad(table, ((0, 0), (0, n - 1))).astype(kind)
                grams = np.zeros((len(table), max(width, 1)), kind)
                for k in range(n):
                    grams = grams * kind(codes) + padded[:, k : k + grams.shape[1]]
                at = np.arange(grams.shape[1])
                grams[(at + n > length[:, None]) & ((at > 0) | (length[:, None] == 0))] = -1
                rows.append(distinct_rows(grams))
            values[part] = jaccards(shared(*rows), *((r >= 0).sum(1) for r in rows))
    return out


class Words:
    """The tokens of distinct texts."""

    def __init__(self, texts: Sequence[str]):
        self.texts = list(texts)
        self.lists = [t.split() for t in self.texts]
        self.sets = [set(w) for w in self.lists]
        self.sorted = [" ".join(sorted(w)) for w in self.lists]
        self.once = [s if len(w) == len(d) else " ".join(sorted(d)) for s, w, d in zip(self.sorted, self.lists, self.sets, strict=True)]
        self.number, self.count = lengths(self.sets), lengths(self.lists)
        self.ends = [np.array([w[k] if w else "" for w in self.lists], object) for k in (0, -1)]


def token_scores(w: Words, i: np.ndarray, j: np.ndarray, ratio: np.ndarray | None) -> dict[str, np.ndarray]:
    """Of pairs of places in w: common (number of common tokens), set (`similarity.token_set`), and where the Indel
    similarity of the whole texts is given, sort and weighted (`token_sort`, `weighted`)."""
    common, best = np.zeros(len(i), np.int64), np.zeros(len(i))
    todo: list[tuple[int, str, str]] = []
    for k, (p, q) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        x, y = w.sets[p], w.sets[q]
        both = x & y
        common[k] = n = len(both)
        if not n:
            best[k] = float(not w.texts[p] and not w.texts[q])
            if x and y:
                todo.append((k, w.once[p], w.once[q]))
        elif n == len(x) or n == len(y):
            best[k] = 1.0
        else:
            start = " ".join(sorted(both))
            one, two = f"{start} {' '.join(sorted(x - both))}", f"{start} {' '.join(sorted(y - both))}"
            best[k] = max(2 * len(start) / (len(start) + len(one)), 2 * len(start) / (len(start) + len(two)))
            todo.append((k, one, two))
    if todo:
        at, one, two = (list(v) for v in zip(*todo, strict=True))
        best[at] = np.maximum(best[at], indels(one, two, distances(one, two)[0]))
    out = {"common": common, "set": best}
    if ratio is None:
        return out
    one, two = [w.sorted[p] for p in i.tolist()], [w.sorted[q] for q in j.tolist()]
    out["sort"] = indels(one, two, distances(one, two)[0])
    la, lb = (lengths([w.texts[p] for p in side.tolist()]) for side in (i, j))
    less, most = np.minimum(la, lb), np.maximum(la, lb)
    score = np.maximum(ratio, np.maximum(0.95 * out["sort"], 0.95 * best))
    score[less == 0] = (most[less == 0] == 0).astype(float)
    far = np.flatnonzero((less > 0) & (most / np.maximum(less, 1) >= 1.5))
    if len(far):
        scale = np.where(most[far] / less[far] <= 8, 0.9, 0.6)
        p, q = i[far].tolist(), j[far].tolist()
        whole, sets = partials([w.texts[k] for k in p], [w.texts[k] for k in q]), np.ones(len(far))
        apart = np.flatnonzero(common[far] == 0)
        if len(apart):
            pick = lambda of, side: [of[side[k]] for k in apart.tolist()]
            sides = partials(pick(w.sorted, p), pick(w.sorted, q))
            twice = [k for k, (a, b) in enumerate(zip(pick(w.number, p), pick(w.number, q), strict=True)) if a != len(w.lists[p[apart[k]]]) or b != len(w.lists[q[apart[k]]])]
            alone = sides.copy()
            if twice:
                alone[twice] = partials([pick(w.once, p)[k] for k in twice], [pick(w.once, q)[k] for k in twice])
            sets[apart] = np.maximum(sides, alone)
        score[far] = np.maximum(ratio[far], np.maximum(scale * whole, 0.95 * scale * sets))
    out["weighted"] = score
    return out


def counts(w: Words, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smaller number of tokens by the larger one; 1 if there is none."""
    most = np.maximum(w.count[i], w.count[j])
    return np.where(most > 0, np.minimum(w.count[i], w.count[j]) / np.maximum(most, 1), 1.0)


def name_scores(w: Words, i: np.ndarray, j: np.ndarray, sizes: tuple[int, ...]) -> dict[str, np.ndarray]:
    a, b = [w.texts[p] for p in i.tolist()], [w.texts[q] for q in j.tolist()]
    lcs, lev = distances(a, b, edits=True)
    ratio = indels(a, b, lcs)
    tokens = token_scores(w, i, j, ratio)
    grams = gram_jaccards(a, b, sizes)
    x, y = w.number[i], w.number[j]
    least, most = np.minimum(x, y), np.maximum(x, y)
    share = lambda of: np.where(of > 0, tokens["common"] / np.maximum(of, 1), 0.0)
    return {
        "levenshtein_ratio": ratio, "normalized_levenshtein": edit_similarity(a, b, lev), "token_sort_ratio": tokens["sort"], "token_set_ratio": tokens["set"], "w_ratio": tokens["weighted"],
        "token_jaccard": jaccards(tokens["common"], x, y), "token_overlap_count": tokens["common"].astype(float), "shared_token_fraction_min": share(least), "shared_token_fraction_max": share(most),
        **{f"char{n}_jaccard": g for n, g in zip(sizes, grams, strict=True)}, "token_count_diff": np.abs(w.count[i] - w.count[j]).astype(float), "token_count_ratio": counts(w, i, j),
        **{f"{k}_token_exact": ((e[i] == e[j]) & (e[i] != "")).astype(float) for k, e in zip(("first", "last"), w.ends, strict=True)},
    }


def of_distinct(texts: np.ndarray, others: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct texts of both, the places of both sides for distinct pairs, and each pair's place among those."""
    codes, values = pd.factorize(np.concatenate([texts, others]))
    i, j = codes[: len(texts)].astype(np.int64), codes[len(texts) :].astype(np.int64)
    at, pairs = pd.factorize(i * len(values) + j)
    return Words(values), pairs // max(len(values), 1), pairs % max(len(values), 1), at


NAME = ("levenshtein_ratio", "normalized_levenshtein", "token_sort_ratio", "token_set_ratio", "w_ratio", "token_jaccard", "token_overlap_count", "shared_token_fraction_min", "char2_jaccard", "char3_jaccard", "char4_jaccard", "first_token_exact")
def bare(t: str) -> str:
    """`text.compact` of a normalised address, which has blanks, - and / beside letters, numbers and marks."""
    return t.replace(" ", "").replace("-", "").replace("/", "")


def costly(n1: np.ndarray, n2: np.ndarray, t2: np.ndarray, k1: np.ndarray, k2: np.ndarray, a1: np.ndarray, a2: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> dict[str, np.ndarray]:
    """Normalised names and the transliterated one, skeletons, normalised addresses, their distinct numbers as texts."""
    out: dict[str, np.ndarray] = {}
    w, i, j, at = of_distinct(n1, n2)
    names = {n: v[at] for n, v in name_scores(w, i, j, (2, 3, 4, 5)).items()}
    out |= {f"name_{n}": v for n, v in names.items()}
    out |= {f"name_translit_{n}": names[n].copy() for n in NAME}
    other = np.flatnonzero(n2 != t2)
    if len(other):
        w, i, j, at = of_distinct(n1[other], t2[other])
        for n, v in name_scores(w, i, j, (2, 3, 4)).items():
            if n in NAME:
                out[f"name_translit_{n}"][other] = v[at]
    w, i, j, at = of_distinct(k1, k2)
    a, b = [w.texts[p] for p in i.tolist()], [w.texts[q] for q in j.tolist()]
    out["consonant_skeleton_levenshtein"] = edit_similarity(a, b, distances(a, b, edits=True)[1])[at]
    out["consonant_skeleton_jaccard"] = gram_jaccards(a, b, (2,))[0][at]
    w, i, j, at = of_distinct(a1, a2)
    a, b = [w.texts[p] for p in i.tolist()], [w.texts[q] for q in j.tolist()]
    lcs, lev = distances(a, b, edits=True)
    tokens = token_scores(w, i, j, None)
    short = [bare(t) for t in w.texts]
    bare_a, bare_b = [short[p] for p in i.tolist()], [short[q] for q in j.tolist()]
    address = {
        "levenshtein_ratio": indels(a, b, lcs), "normalized_levenshtein": edit_similarity(a, b, lev), "compact_similarity": edit_similarity(bare_a, bare_b, distances(bare_a, bare_b, edits=True)[1]),
        "token_jaccard": jaccards(tokens["common"], w.number[i], w.number[j]), "token_set_ratio": tokens["set"], "char3_ngram_jaccard": gram_jaccards(a, b, (3,))[0], "token_count_ratio": counts(w, i, j),
    }
    out |= {f"address_{n}": v[at] for n, v in address.items()}
    w, i, j, at = of_distinct(d1, d2)
    both = np.fromiter((len(w.sets[p] & w.sets[q]) for p, q in zip(i.tolist(), j.tolist(), strict=True)), np.int64, len(i))
    out["address_numeric_token_overlap"], out["address_numeric_token_jaccard"] = both[at].astype(float), jaccards(both, w.number[i], w.number[j])[at]
    return out


def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smaller number by the larger one; 1 if both are 0."""
    most = np.maximum(a, b)
    return np.where(most > 0, np.minimum(a, b) / np.maximum(most, 1), 1.0)


def light(x: dict[str, np.ndarray], y: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The features that need no more than comparisons and lengths of the texts of x and y (as `features.light_columns`, but
    for those of ids and rules)."""
    same = lambda a, b: (a == b) & (a != "")
    n1, n2, nt, s1, s2, p1, p2 = map(lengths, (x["norm"], y["norm"], y["trans"], x["skel"], y["skel"], x["postal"], y["postal"]))
    prefix = lambda a, b, la, lb, n: (la >= n) & (lb >= n) & np.fromiter((p[:n] == q[:n] for p, q in zip(a, b, strict=True)), bool, len(a))
    m1, m2 = ((r["address"] == "") | (r["address"] == "none") | (r["address"] == "null") | (r["address"] == "undefined") for r in (x, y))
    none = {c: [r[c] == "" for r in (x, y)] for c in ("postal", "house")}
    i1, i2 = x["indic"], y["indic"]
    return {
        **{f"name_{n}exact": same(x[c], y[c]) for n, c in (("", "norm"), ("compact_", "compact"), ("nosuff_", "nosuff"))}, "name_translit_exact": same(x["norm"], y["trans"]), "name_nosuff_translit_exact": same(x["nosuff"], y["trans_nosuff"]),
        "name_length_diff": np.abs(n1 - n2), "name_length_ratio": ratio(n1, n2),
        **{f"name_prefix{n}_exact": prefix(x["norm"], y["norm"], n1, n2, n) for n in (3, 4, 5)}, "name_translit_prefix3_exact": prefix(x["norm"], y["trans"], n1, nt, 3),
        "consonant_skeleton_exact": same(x["skel"], y["skel"]), "consonant_skeleton_len_diff": np.abs(s1 - s2), "consonant_skeleton_len_ratio": ratio(s1, s2),
        "address_exact": x["address"] == y["address"], "address_length_ratio": ratio(*(lengths(r["address"]) for r in (x, y))),
        "house_number_exact": same(x["house"], y["house"]), "postal_code_exact": same(x["postal"], y["postal"]), "postal_code_prefix3_exact": prefix(x["postal"], y["postal"], p1, p2, 3),
        "s1_address_missing": m1, "candidate_address_missing": m2, "both_address_missing": m1 & m2, "either_address_missing": m1 | m2,
        **{f"{c}_missing_either": a | b for c, (a, b) in none.items()}, **{f"{c}_missing_both": a & b for c, (a, b) in none.items()},
        "same_country": same(x["country"], y["country"]), "s1_has_indic": i1, "candidate_is_indic": i2, "is_cross_script": i1 != i2, "name_has_transliteration": y["trans"] != y["norm"], "s1_script_latin": ~i1, "candidate_script_latin": ~i2,
    }


def whole(x: dict[str, np.ndarray], y: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """All features of pairs of records, but for those of ids and rules. x, y: columns of `features.narrow`."""
    out = light(x, y) | costly(x["norm"], y["norm"], y["trans"], x["skel"], y["skel"], x["address"], y["address"], x["nums"], y["nums"])
    either, lev = out["either_address_missing"], out["name_normalized_levenshtein"]
    out |= {n: np.where(either, 0.0, v) for n, v in out.items() if n.startswith("address")}
    most_name = np.maximum.reduce([out[n] for n in ("name_normalized_levenshtein", "name_translit_normalized_levenshtein", "name_token_sort_ratio", "name_token_set_ratio", "name_w_ratio", "consonant_skeleton_levenshtein")])
    most_address = np.maximum.reduce([out[n] for n in ("address_normalized_levenshtein", "address_token_jaccard", "address_token_set_ratio", "address_char3_ngram_jaccard")])
    postal, house, tokens = out["postal_code_exact"], out["house_number_exact"], out["address_token_jaccard"]
    return out | {
        "same_postal_and_high_name_sim": postal & (lev >= 0.7), "same_house_and_high_name_sim": house & (lev >= 0.7), "same_postal_and_same_house": postal & house,
        "same_postal_and_same_name_prefix": postal & out["name_prefix3_exact"], "addr_sim_x_name_sim": tokens * lev, "max_name_similarity": most_name, "max_address_similarity": most_address,
        "name_and_addr_high_confidence": (most_name >= 0.8) & (most_address >= 0.6), "name_exact_diff_address": (out["name_exact"] | out["name_translit_exact"]) & ~either & (tokens < 0.2),
    }
