"""Language tests and the keyword verdict on a model reply."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference job's behaviour)
# ---------------------------------------------------------------------------
# Korean replies: polarity words 긍정 (positive), 부정 (negative);
# statement words 사실, 진술.
KO_POLARITY = ("긍정", "부정")
KO_STATEMENT = ("사실", "진술")
# English replies: polarity words positive, negative; statement words statement, fact.
EN_POLARITY = ("positive", "negative")
EN_STATEMENT = ("statement", "fact")
# Korean = any Hangul syllable 가..힣. English = any character whose lower case
# lies in a..z: ASCII letters plus U+0130 (İ) and U+212A (Kelvin sign).
KOREAN_PATTERN = "[가-힣]"
ENGLISH_PATTERN = r"[A-Za-z\x{130}\x{212A}]"
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_korean(col) -> Column:
    return _c(col).rlike(KOREAN_PATTERN)


def is_english(col) -> Column:
    return _c(col).rlike(ENGLISH_PATTERN)


def detect_language(col) -> Column:
    """Korean wins over English, else 'Unknown'."""
    return (F.when(is_korean(col), F.lit("Korean"))
            .when(is_english(col), F.lit("English"))
            .otherwise(F.lit("Unknown")))


def _branch_label(c: Column, polarity, statement, neutral: str) -> Column:
    pos_w, neg_w = polarity
    stmt = (c.contains(pos_w) & c.contains(neg_w))
    for w in statement:
        stmt = stmt | c.contains(w)
    where = F.instr(c, neg_w)  # 1-based; 0 = absent
    return (F.when(stmt, F.lit(neutral))
            .when(where == 0, F.lit("P"))
            .when(where == 1, F.lit(neutral))
            .otherwise(F.lit("N")))


def verdict(col, neutral: str = "P",
            ko=(KO_POLARITY, KO_STATEMENT), en=(EN_POLARITY, EN_STATEMENT)) -> Column:
    """Keyword verdict on a reply.

    Position of the negative word (0-based, -1 absent) decides: -1 -> P, >= 1 -> N,
    0 -> ``neutral`` ('P' in the main job, 'C' in the three-way variant). Both
    polarity words or any statement word force position 0, as does a reply that
    is neither Korean nor English.
    """
    c = _c(col)
    return (F.when(is_korean(c), _branch_label(c, ko[0], ko[1], neutral))
            .when(is_english(c), _branch_label(c, en[0], en[1], neutral))
            .otherwise(F.when(c.isNotNull(), F.lit(neutral))))
