"""Token-set ratio kernels (D3), used inside Arrow UDFs on candidate pairs only.

Definitions (insert/delete edit ratio, half-even rounding):
  normalise: drop U+0080..U+00FF, non-word chars -> ' ', lower, strip
  S = sorted shared tokens, A/B = sorted tokens only on the left/right, joined by ' '
  score = max(r(S, S+A), r(S, S+B), r(S+A, S+B)), r(x, y) = round(100 * 2*LCS / (|x|+|y|)),
  100 when x == y, 0 when one side is empty.
"""

from __future__ import annotations

import re

_HIGH_LATIN1 = dict.fromkeys(range(128, 256))
_NON_WORD = re.compile(r"(?ui)\W")


def normalize(s: str) -> str:
    s = s.translate(_HIGH_LATIN1)
    return _NON_WORD.sub(" ", s).lower().strip()


def lcs_len(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a`` (Hyyro 2004)."""
    if not a or not b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        m = masks.get(ch)
        if m is None:
            continue
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def ratio_from(lcs: int, lensum: int) -> int:
    if lensum == 0:
        return 100
    return int(round(100 * ((2 * lcs) / lensum)))


def ratio(x: str, y: str) -> int:
    if x == y:
        return 100
    if not x or not y:
        return 0
    return ratio_from(lcs_len(x, y), len(x) + len(y))


def token_set_ratio(s1: str, s2: str) -> int:
    p1, p2 = normalize(s1 or ""), normalize(s2 or "")
    if not p1 or not p2:
        return 0
    t1, t2 = set(p1.split()), set(p2.split())
    sect = " ".join(sorted(t1 & t2))
    d12 = " ".join(sorted(t1 - t2))
    d21 = " ".join(sorted(t2 - t1))
    c12 = (sect + " " + d12).strip()
    c21 = (sect + " " + d21).strip()
    sect = sect.strip()
    return max(ratio(sect, c12), ratio(sect, c21), ratio(c12, c21))


def char_bound(a: str, b: str) -> int:
    """Upper bound of LCS(a, b): sum over characters of the smaller count."""
    ca: dict[str, int] = {}
    for ch in a:
        ca[ch] = ca.get(ch, 0) + 1
    cb: dict[str, int] = {}
    for ch in b:
        cb[ch] = cb.get(ch, 0) + 1
    return sum(min(n, cb.get(ch, 0)) for ch, n in ca.items())

