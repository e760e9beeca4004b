"""What documents and web pages say about themselves: links, abstracts, titles, authors, years, DOIs."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mortarline.functions import phrases as P
from mortarline.operators.identity import cleaned_doi

MIN_ABSTRACT = 50
HEADER_WORDS = r"(?i)journal|vol(?:ume)?|issue|pages?|issn|doi|copyright|published by|all rights reserved|arxiv|biorxiv|medrxiv|preprint"


def stripped_html(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", ""), r"\s+", " "))


def html_abstract(html: Column) -> Column:
    """The first abstract of more than 50 characters by the known page layouts, else the last one that matched at all."""
    texts = [stripped_html(F.nullif(F.regexp_extract(html, p, 1), F.lit(""))) for p in P.ABSTRACT_PATTERNS]
    long = F.coalesce(*[F.when(F.length(t) > MIN_ABSTRACT, t) for t in texts])
    return F.coalesce(long, *[F.nullif(t, F.lit("")) for t in reversed(texts)])


def pdf_links(*texts: Column) -> Column:
    """All addresses of PDF files in the given texts, each once, in order."""
    found = [F.coalesce(F.regexp_extract_all(t, F.lit(P.PDF_LINK), F.lit(0)), F.array().cast("array<string>")) for t in texts]
    return F.array_distinct(F.concat(*found))


def doi_links(*texts: Column) -> Column:
    found = [F.coalesce(F.regexp_extract_all(t, F.lit(r"https?://doi\.org/[^\s<>\"']+"), F.lit(0)), F.array().cast("array<string>")) for t in texts]
    return F.array_distinct(F.concat(*found))


@F.pandas_udf(T.ArrayType(T.StringType()))
def absolute_links(base: pd.Series, links: pd.Series) -> pd.Series:
    return pd.Series([[urljoin(b or "", x) for x in (ls if ls is not None else [])] for b, ls in zip(base, links, strict=True)])


def entry_links(link: Column, summary: Column, page_html: Column, enclosures: Column) -> Column:
    """PDF links of a feed entry by the first way that gives any: in its text, of a preprint's abstract page, as typed links, those of its page made absolute.

    ``enclosures``: array of struct(href, type, title).
    """
    texts = pdf_links(summary, link)
    preprint = F.when(link.rlike(r"arxiv\.org/abs/"), F.array(F.concat(F.replace(link, F.lit("/abs/"), F.lit("/pdf/")), F.lit(".pdf")))).otherwise(F.array().cast("array<string>"))
    typed = F.transform(F.filter(F.coalesce(enclosures, F.array().cast("array<struct<href:string,type:string,title:string>>")), lambda e: (e["type"] == "application/pdf") | (F.lower(e["title"]) == "pdf")), lambda e: e["href"])
    on_page = F.coalesce(F.regexp_extract_all(page_html, F.lit(r"(?i)href=[\"']([^\"']+\.pdf[^\"']*)[\"']"), F.lit(1)), F.array().cast("array<string>"))
    return F.when(F.size(texts) > 0, texts).when(F.size(preprint) > 0, preprint).when(F.size(typed) > 0, F.array_distinct(typed)).otherwise(absolute_links(link, on_page))


def abstract_link(links: Column, *texts: Column) -> Column:
    """The first link of a feed entry to an abstract: one of its own to doi.org or ascelibrary.org, else the first DOI link in its texts."""
    own = F.filter(F.coalesce(links, F.array().cast("array<string>")), lambda x: F.contains(x, F.lit("doi.org")) | F.contains(x, F.lit("ascelibrary.org")))
    return F.get(F.concat(own, doi_links(*texts)), F.lit(0))


def year_in(c: Column) -> Column:
    """The first year 19xx or 20xx in a text as a number, null if there is none."""
    return F.regexp_extract(c, r"((?:19|20)\d{2})", 1).try_cast("int")


def first_page(text: Column, scan: int = 10) -> dict[str, Column]:
    """title, authors, doi and year guessed from a document's first page."""
    lines = F.filter(F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    head = F.slice(lines, 1, scan)
    title = F.get(F.filter(head, lambda x: (F.length(x) >= 5) & ~x.rlike(HEADER_WORDS)), F.lit(0))
    away = lambda x: F.lower(x).rlike("|".join(map(_quoted, P.AFFILIATIONS)) + r"|@|https?://|www\.")
    named = F.filter(F.slice(lines, 2, scan - 1), lambda x: ~away(x) & (x.contains(",") | F.lower(x).contains(" and ")) & (F.length(x) > 3) & (F.length(x) < 200))
    doi_line = F.get(F.filter(lines, lambda x: F.lower(x).contains("doi") & x.rlike(r"10\.\d{4,9}/")), F.lit(0))
    doi = F.nullif(F.regexp_replace(F.regexp_extract(doi_line, r"(?i)10\.\d{4,9}/[-._;()/:A-Z0-9<>%+,]+", 0), r"[.,;:]+$", ""), F.lit(""))
    year = year_in(F.get(F.reverse(F.filter(lines, lambda x: x.rlike(r"(?:19|20)\d{2}"))), F.lit(0)))
    return {"title": title, "authors": F.coalesce(F.get(named, F.lit(0)), F.get(lines, F.lit(1))), "doi": doi, "year": year}


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in ".+*?()[]{}|^$\\" else c for c in s)


def document_metadata(meta: Column, text: Column) -> dict[str, Column]:
    """A map of a file's own metadata first, the first page's guesses where it is silent."""
    page = first_page(text)
    own = lambda k: F.nullif(F.trim(F.try_element_at(meta, F.lit(k))), F.lit(""))
    subject = F.nullif(cleaned_doi(F.regexp_extract(own("Subject"), r"10\.\d{4,9}/[-._;()/:A-Za-z0-9<>%+,]+", 0)), F.lit(""))
    return {"title": F.coalesce(own("Title"), page["title"]), "authors": F.coalesce(own("Author"), page["authors"]), "year": F.coalesce(year_in(own("CreationDate")), page["year"]), "doi": F.coalesce(subject, page["doi"])}


def research_domain(meta: Column) -> Column:
    own = lambda k: F.nullif(F.try_element_at(meta, F.lit(k)), F.lit(""))
    return F.coalesce(own("domain"), own("research_domain"), own("field"), own("area"), F.lit("methods_tooling"))


def context_window(text: Column, term: Column, width: int = 50) -> Column:
    """position and surroundings of a term's first occurrence, case aside; null if it does not occur."""
    at = F.call_function("locate", F.lower(term), F.lower(text))
    start = F.greatest(at - width, F.lit(1))
    return F.when(at > 0, F.struct((at - 1).alias("start"), (at - 1 + F.length(term)).alias("end"), F.substr(text, start, at + F.length(term) + width - start).alias("window")))
