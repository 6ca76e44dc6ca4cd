"""Enrichment hook (U1) and model request tables.

External calls (translation, language models) are not made here. ``P21``
builds the request text as columns; ``U1`` is the per-row hook a deployment
plugs a client into: Arrow batches through ``mapInPandas``, each row guarded,
a failing row gets its fallback instead of failing the task.
"""
from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import let

# ---------------------------------------------------------------------------
# Request templates (must equal the reference job's text)
# ---------------------------------------------------------------------------
# Headline polarity question (Korean): "<headline> is this sentence positive? negative?"
KO_QUESTION_SUFFIX = " 이 문장이 긍정문이야? 부정문이야?"
# Company summary request; the token 동사는 is removed from the filled text.
SUMMARY_TEMPLATE = ("Please summarize the following text using bullet points:\n\n 기업명 : {name}\n\n"
                    " 기업개요 : {overview}\n\n 현재상황 : {status}")
SUMMARY_DROP = "동사는"
# The class of the page's block that holds the company's summary.
SUMMARY_CLASS = "um_bssummary"
# US headline request (Korean): company introduction and status in five sentences.
US_TEMPLATE = ("다음 문장은 나스닥 상장사 {company_name}의 오늘 뉴스 타이틀 입니다. {article}. "
               "이 회사의 간단한 소개 및 현재 상황을 문장 기호를 사용하여 5문장 이내로 알려 주세요. "
               "(물론입니다.는 생략 해 주세요)")
# Plain summary request, and the one of a corporate report: the text follows.
TEXT_SUMMARY = "Please summarize the following text:\n\n"
REPORT_SUMMARY = ("The following text is part of a corporate report. Please summarize the main aspects of this company "
                  "in 5 sentences or less. using bullet points:\n\n")
# Labelled examples of the completion request: text, label (부정 negative, 긍정 positive).
EXAMPLES = [
    ("가격대비좀 부족한게많은듯", "부정"),
    ("재구매 친구들이 좋은 향 난다고 해요", "긍정"),
    ("ㅠㅠ약간 후회가 됩니다..", "부정"),
    ("이전에 먹고 만족해서 재구매합니다", "긍정"),
]
# Fallback reply when a summary request fails.
SUMMARY_FAILED = "unable to summarize the company report."
# ---------------------------------------------------------------------------


def _fill(template: str, **cols: Column) -> Column:
    """Template with {name} slots -> concat of literals and columns."""
    parts, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            parts.append(F.lit(head))
        parts.append(F.coalesce(cols[name].cast("string"), F.lit("None")))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)


def ko_question(headline: Column) -> Column:
    return F.concat(headline, F.lit(KO_QUESTION_SUFFIX))


def summary_request(name: Column, overview: Column, status: Column) -> Column:
    return F.replace(_fill(SUMMARY_TEMPLATE, name=name, overview=overview, status=status),
                     F.lit(SUMMARY_DROP), F.lit(""))


def company_summary(html: Column) -> Column:
    """struct(overview, status): the first ``li`` and ``h3`` elements of the summary block of a
    company's page, as markup; null when the page has no such block."""
    block = F.regexp_extract(html, rf"""(?is)<div\b[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?{SUMMARY_CLASS}(?:\s[^"']*)?["'][^>]*>(.*?)</div\s*>""", 0)

    def read(b: Column) -> Column:
        first = lambda tag: F.nullif(F.regexp_extract(b, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", 0), F.lit(""))
        return F.when(b != "", F.struct(first("li").alias("overview"), first("h3").alias("status")))
    return let(block, read)


def asked_summary(name: Column, summary: Column) -> Column:
    """The summary request of a company from its page's ``company_summary``; null without one."""
    return F.when(summary.isNotNull(), summary_request(name, summary["overview"], summary["status"]))


def company_request(name: Column, html: Column) -> Column:
    """The summary request of a company's page, its summary put in like the job does; null when
    the page has no summary block."""
    return let(company_summary(html), lambda s: asked_summary(name, s))


def text_summary_request(text: Column) -> Column:
    return F.concat(F.lit(TEXT_SUMMARY), text)


def report_summary_request(text: Column) -> Column:
    return F.concat(F.lit(REPORT_SUMMARY), text)


def completion_request(headline: Column, examples: list[tuple[str, str]] = EXAMPLES) -> Column:
    """Labelled examples, one a line, and the headline whose label a model is to complete."""
    shown = "".join(f"{text}={label}\n" for text, label in examples)
    return F.concat(F.lit("\n" + shown), headline, F.lit("=\n"))


def us_request(company_name: Column, article: Column) -> Column:
    return _fill(US_TEMPLATE, company_name=company_name, article=article)


def batch_enrich(df: DataFrame, fn: Callable[[str], str], in_col: str, out_col: str,
                 fallback_col: str | None = None, fallback_value: str | None = None) -> DataFrame:
    """``out_col = fn(in_col)`` per row, on Arrow batches; a row whose call
    raises gets ``fallback_col`` (or ``fallback_value``)."""
    from ..session import ensure_shipped
    ensure_shipped(df.sparkSession)  # ``run`` executes in Python workers
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.StringType(), True)])
    fb_name = fallback_col

    def run(batches):
        for pdf in batches:
            vals = pdf[in_col].tolist()
            fbs = pdf[fb_name].tolist() if fb_name else [fallback_value] * len(vals)
            out = []
            for v, fb in zip(vals, fbs):
                try:
                    out.append(fn(v))
                except Exception:  # noqa: BLE001 - per-row guard is the contract
                    out.append(fb)
            pdf[out_col] = pd.Series(out, index=pdf.index, dtype=object)
            yield pdf
    return df.mapInPandas(run, schema)
