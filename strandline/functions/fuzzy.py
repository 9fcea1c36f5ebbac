"""Edit metrics and token ratios in plain Python, used inside Arrow-batched operators."""

from __future__ import annotations


def levenshtein(a: str, b: str, most: int | None = None) -> int:
    """Edit distance (insert, delete, substitute) by the bit-parallel algorithm over one machine word per 64 letters; a
    value above `most` may be returned early when the lengths alone exceed it."""
    if a == b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    if most is not None and len(a) - len(b) > most:
        return len(a) - len(b)
    n = len(b)
    if not n:
        return len(a)
    peq: dict[str, int] = {}
    for i, c in enumerate(b):
        peq[c] = peq.get(c, 0) | (1 << i)
    mask, top = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score = mask, 0, n
    for c in a:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) | 1
        mh <<= 1
        pv = (mh | ~(xv | ph)) & mask
        mv = ph & xv & mask
    return score


def damerau(a: str, b: str) -> int:
    """Unrestricted Damerau–Levenshtein distance (a true metric): insert, delete, substitute, swap of neighbours."""
    if a == b:
        return 0
    la, lb = len(a), len(b)
    inf = la + lb
    last: dict[str, int] = {}
    d = [[0] * (lb + 2) for _ in range(la + 2)]
    d[0][0] = inf
    for i in range(la + 1):
        d[i + 1][0] = inf
        d[i + 1][1] = i
    for j in range(lb + 1):
        d[0][j + 1] = inf
        d[1][j + 1] = j
    for i in range(1, la + 1):
        seen = 0
        for j in range(1, lb + 1):
            k, m = last.get(b[j - 1], 0), seen
            cost = 1
            if a[i - 1] == b[j - 1]:
                cost, seen = 0, j
            d[i + 1][j + 1] = min(d[i][j] + cost, d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[a[i - 1]] = i
    return d[la + 1][lb + 1]


def indel_ratio(a: str, b: str) -> float:
    """200·LCS/(|a|+|b|), 100 for two empty strings."""
    if not a and not b:
        return 100.0
    return 200.0 * _lcs(a, b) / (len(a) + len(b))


def _lcs(a: str, b: str) -> int:
    if not a or not b:
        return 0
    peq: dict[str, int] = {}
    for i, c in enumerate(a):
        peq[c] = peq.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & peq.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the shared words alone and the shared words with either side's rest."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_a, only_b = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not only_a or not only_b):
        return 100.0
    base = " ".join(both)
    left, right = " ".join([*both, *only_a]), " ".join([*both, *only_b])
    return max(indel_ratio(left, right), *((indel_ratio(base, left), indel_ratio(base, right)) if both else (0.0,)))


def partial_ratio(a: str, b: str, cutoff: float = 0.0) -> float:
    """The best ratio of the shorter text with any window of the longer one of the same or smaller length; 0 where the
    letters in common order can't reach the cutoff."""
    s, t = (a, b) if len(a) <= len(b) else (b, a)
    if not s:
        return 100.0 if not t else 0.0
    n, most = len(s), _lcs(s, t)
    if 200.0 * most / (n + most) < cutoff or not most:
        return 0.0
    best, letters = 0.0, set(s)
    for i in range(1 - n, len(t)):
        w = t[max(0, i) : i + n]
        if w and (w[0] in letters or w[-1] in letters):
            best = max(best, indel_ratio(s, w))
            if best == 100.0:
                break
    return best


def most_possible(a: str, b: str, common: int) -> float:
    """An upper bound of `weighted_ratio` from the number of letters in common (with multiplicity)."""
    shorter = min(len(a), len(b))
    return 100.0 if set(a.split()) & set(b.split()) else max(200.0 * common / (len(a) + len(b)), 100.0 * common / shorter if shorter else 0.0)


def weighted_ratio(a: str, b: str, cutoff: float = 0.0) -> float:
    """The mix of plain, token and partial ratios, scaled by how different the lengths are; 0 where it can't reach the cutoff."""
    if not a or not b:
        return 0.0
    if cutoff:
        common = sum(min(a.count(c), b.count(c)) for c in set(a))
        if most_possible(a, b, common) < cutoff:
            return 0.0
    whole = indel_ratio(a, b)
    length = max(len(a), len(b)) / min(len(a), len(b))
    if length < 1.5:
        return max(whole, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if length <= 8 else 0.6
    best = max(whole, scale * partial_ratio(a, b, max(whole, cutoff) / scale))
    x, y = set(a.split()), set(b.split())
    if x & y:
        tokens = 100.0
    else:
        need = max(best, cutoff) / (0.95 * scale)
        tokens = partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())), need)
    return max(best, 0.95 * scale * tokens)
