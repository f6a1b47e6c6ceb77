"""FLT6: text match on an analysed field, as built-in array expressions.

A match query is the OR of its tokens: a row matches when its text shares at least one token with the query.
Tokens are maximal runs of letters/digits, lower-cased.  Text without word breaks (e.g. CJK) cannot be split
into words without a dictionary, so a query token of such a script matches as a substring.
Ranking by relevance is in ``operators.search_index``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a token is a maximal run of Unicode letters or digits.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
_PY_TOKEN = re.compile(r"[^\W_]+", re.UNICODE)
_NO_BREAK_SCRIPT = re.compile(r"[぀-ヿ㐀-䶿一-鿿가-힯]")


def query_tokens(text: str) -> list[str]:
    """Tokens of the (small, driver-side) query string."""
    return sorted({t.lower() for t in _PY_TOKEN.findall(text or "")})


def tokens(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.lower(col), TOKEN_SPLIT), lambda t: t != F.lit(""))


def matches(c: Column | str, query: str) -> Column:
    """True when the text shares a token with ``query``; an empty query matches every row."""
    col = F.col(c) if isinstance(c, str) else c
    qt = query_tokens(query)
    if not qt:
        return F.lit(True)
    word_tokens = [t for t in qt if not _NO_BREAK_SCRIPT.search(t)]
    cjk_tokens = [t for t in qt if _NO_BREAK_SCRIPT.search(t)]
    conds = []
    if word_tokens:
        conds.append(F.arrays_overlap(tokens(col), F.array(*[F.lit(t) for t in word_tokens])))
    for t in cjk_tokens:
        conds.append(F.lower(col).contains(t))
    out = conds[0]
    for c2 in conds[1:]:
        out = out | c2
    return F.coalesce(out, F.lit(False))
