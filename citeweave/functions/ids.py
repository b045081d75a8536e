"""Identifiers: finding, repairing, choosing and minting them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Preprint groups, most submissions first; the order decides.
PREPRINT_GROUPS = (
    "cond-mat", "astro-ph", "hep-ph", "math", "hep-th", "quant-ph", "gr-qc", "physics", "nucl-th", "hep-lat", "hep-ex", "cs",
    "nlin", "nucl-ex", "q-bio", "chao-dyn", "alg-geom", "q-alg", "cmp-lg", "solv-int", "dg-ga", "patt-sol", "funct-an",
    "adap-org", "mtrl-th", "comp-gas", "chem-ph", "supr-con", "atom-ph", "acc-phys", "plasm-ph", "ao-sci", "bayes-an",
)
# Work types by publication type; any other is an Expression.
WORK_TYPES = {
    "journal": "JournalArticle", "book": "Book", "thesis": "Thesis", "database": "Database", "weblink": "WebPage",
    "webpage": "WebPage", "web": "WebSite", "patent": "Patent", "confproc": "ConferenceProceedings",
    "conf-proceeding": "ConferenceProceedings", "conf-proc": "ConferenceProceedings", "computer-program": "ComputerProgram",
    "commun": "PersonalCommunication", "report": "Report", "other": "Expression", "other-ref": "Expression", "undeclared": "Expression",
}
# Patent offices by how a number begins.
PATENT_OFFICES = {"us": ("US", "U.S.", "United States"), "wipo": ("WO", "Patent WO"), "fr": ("French patent application",), "euro": ("EP",), "de": ("German Pat.",)}


def _found(s: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(s, pattern, group), F.lit(""))


def canonical(scheme: Column, value: Column) -> Column:
    """``type:id``; null where either is missing."""
    return F.concat(scheme, F.lit(":"), value)


def preprint_id(s: Column) -> tuple[Column, Column]:
    """(id after ``arxiv:`` in new or old style, the text without it)."""
    pattern = r"(?i)arxiv:\s*(\d{4}\.\d{4,5}(?:v\d+)?|[a-z-]+(?:\.[a-z]{2})?/\d{7}(?:v\d+)?)"
    return _found(s, pattern), F.regexp_replace(s, pattern, "")


def guess_preprint_id(s: Column) -> Column:
    """New style after a tolerant prefix, then an abstract's address, then an old number after a group's name."""
    new = _found(s, r"(?i)arxiv[:\s/]*(?:[a-z-]+(?:\.[a-z]+)?/)?(\d{4}\.\d{4})")
    address = _found(s, r"(?i)arxiv\.org/abs/(\d{4}\.\d{4})")
    groups = F.array(*[F.lit(g) for g in PREPRINT_GROUPS])
    found = F.regexp_extract_all(s, F.lit(r"(.{10}/\d{7})"), 1)

    def old(x: Column) -> Column:
        group = F.try_element_at(F.filter(groups, lambda g: F.contains(F.left(x, F.lit(10)), g)), F.lit(1))
        return F.concat(group, F.lit("/"), F.right(x, F.lit(7)))

    return F.coalesce(new, address, F.try_element_at(F.filter(F.transform(found, old), lambda x: x.isNotNull()), F.lit(1)))


def guess_doi(s: Column) -> Column:
    return F.regexp_replace(_found(s, r"(10\.\d{4,}/[^\s\"<>]+)"), r"[.,;)]+$", "")


def repair_preprint_id(s: Column) -> Column:
    """A group's name with seven digits right after it, as ``group/1234567``; what follows is dropped, others unchanged."""
    group, number = (F.regexp_extract(s, r"(?i)^([a-z][a-z-]+)([0-9]{7})", i) for i in (1, 2))
    return F.when(group != "", F.concat_ws("/", group, number)).otherwise(s)


def id_from_path(s: Column, suffix: int = 3) -> Column:
    """The file's name without its last characters."""
    name = F.substring_index(s, "/", -1)
    return F.left(name, F.length(name) - suffix)


def repair_doi(s: Column) -> Column:
    """``10.dddd/...``, with a missing or garbled beginning (``10:``, ``1.``) put right; null if hopeless."""
    rest = _found(s, r"^(?:10?[.:])?([0-9]{4,9}/\S.*)$")
    return F.concat(F.lit("10."), rest)


def doi_uri_part(s: Column) -> Column:
    """A DOI as a path: per-cent codes for what a path can't hold."""
    out = F.replace(s, F.lit("%"), F.lit("%25"))
    for c, code in (('"', "%22"), ("#", "%23"), (" ", "%20"), ("?", "%3F"), ("<", "%3C"), (">", "%3E")):
        out = F.replace(out, F.lit(c), F.lit(code))
    return out


def preferred_id(pmid: Column, pmc: Column, doi: Column, first: Column) -> Column:
    return F.coalesce(F.concat(F.lit("pmid:"), pmid), F.concat(F.lit("pmc:"), pmc), F.concat(F.lit("doi:"), doi), first)


def work_uri(web: Column, doi: Column, isbn: Column, pmid: Column, group: Column) -> Column:
    """web, doi, isbn, pmid, in this order; else from the group's hash."""
    return F.coalesce(
        web, F.concat(F.lit("doi/"), doi_uri_part(doi)), F.concat(F.lit("isbn/"), isbn), F.concat(F.lit("pmid/"), pmid),
        F.concat(F.lit("work/"), F.sha1(group.cast("string").cast("binary"))),
    )


def journal_uri(issn: Column, abbreviation: Column, name: Column) -> Column:
    from citeweave.functions.text import slug

    return F.coalesce(*[F.concat(F.lit(f"journal/{k}/"), v) for k, v in (("issn", issn), ("abbr", slug(abbreviation)), ("name", slug(name)))])


def content_id(kind: str, title: Column, source: Column, year: Column, publisher: Column) -> Column:
    """``j:`` or ``b:`` and a hash of what the record says."""
    said = F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in (title, source, year, publisher)])
    return F.concat(F.lit(f"{kind}:"), F.md5(said.cast("binary")))


def work_type(kind: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in WORK_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, kind), F.lit("Expression"))


def hyphenated(s: Column) -> Column:
    """``JournalArticle`` as ``journal-article``."""
    return F.lower(F.regexp_replace(F.regexp_replace(s, "([A-Z])", "-$1"), "^-", ""))


def patent_id(s: Column) -> Column:
    """``office:number``; a bare number is of the office ``us``, an unknown beginning gives null."""
    office = F.when(s.rlike(r"^\d"), F.lit("us"))
    for name, starts in PATENT_OFFICES.items():
        for start in starts:
            office = F.when(s.startswith(start), F.lit(name)).otherwise(office)
    number = F.regexp_replace(F.regexp_replace(F.substring_index(s, "/", -1), r"\D", ""), "^0+(?=\\d)", "")
    return F.when(number != "", F.concat(office, F.lit(":"), number))


def salvage(s: Column) -> dict[str, Column]:
    """doi, year, pages and address out of a citation's text."""
    return {
        "doi": guess_doi(s),
        "year": _found(s, r"\b((?:18|19|20)\d{2})\b"),
        "pages": _found(s, r"\b(\d+\s*[-\u2013]\s*\d+)\b"),
        "uri": _found(s, r"(https?://[^\s<>\"]+)"),
    }


def complete_last_page(first: Column, last: Column) -> Column:
    """``1234`` and ``8`` as ``1238``."""
    short = F.length(last) < F.length(first)
    return F.when(short, F.concat(F.left(first, F.length(first) - F.length(last)), last)).otherwise(last)


def page_range(first: Column, last: Column) -> Column:
    full = complete_last_page(first, last)
    return F.when(last.isNull() | (full == first), first).otherwise(F.concat(first, F.lit("-"), full))


def without_prefix(s: Column, prefix: str = "PMC") -> Column:
    return F.regexp_replace(s, f"^{prefix}", "")
