import math

import pytest
from pyspark.sql import functions as F

from citeweave.functions import audit, dates, ids, similarity, tex, text, urls


@pytest.fixture(scope="module")
def apply(spark):
    """The value of a column function for given texts."""

    def run(f, *args):
        df = spark.createDataFrame([tuple(args)], ", ".join(f"a{i} string" for i in range(len(args))))
        return df.select(f(*[F.col(f"a{i}") for i in range(len(args))]).alias("x")).first().x

    return run


@pytest.mark.parametrize(
    ("f", "args", "want"),
    [
        (text.to_ascii, ("Émile Zöla ﬁn",), "Emile Zola fin"),
        (text.to_char_refs, ("é<",), "&#233;<"),
        (text.clean_field, ("a|b\ncé",), "abce"),
        (text.strip_end_punctuation, ("A title. , ",), "A title"),
        (text.unwrap_braces, ("{ Inside }.",), "Inside"),
        (text.unwrap_braces, ("{a} b",), "{a} b"),
        (text.token_coverage, ("The big the", "the big one"), 2 / 3),
        (text.token_coverage, ("", "x"), 0.0),
        (text.guess_year, ("born (1994) died 2001",), 1994),
        (text.guess_year, ("1999, then 2005.",), 2005),
        (text.guess_year, ("page 3000 of 1700",), None),
        (text.guess_year, ("to appear (2040)",), 2040),
        (text.surname, ("Last, First",), "Last"),
        (text.abbreviated, ("Last, First Mid",), "Last F. M."),
        (text.slug, ("A “curly” Name -- of: things!",), "a-curly-name-of-things"),
        (text.tidy_journal, ("J. Biol.  Chem.",), "j biol chem"),
        (text.emails, ("a@b.org, c.d@e.co.uk a@b.org",), ["a@b.org", "c.d@e.co.uk"]),
        (text.spread_initials, ("RJ Smith",), "R J Smith"),
        (text.search_terms, ("Dark-matter, halos",), ["dark", "matter", "halos"]),
        (tex.without_comments, ("a % b\nc",), "a \nc"),
        (tex.without_comment_lines, ("% only\na %b",), "a %b"),
        (lambda s: tex.environment(s, "x"), (r"\begin{x}1\end{x} - \begin{x}2\end{x}",), "12"),
        (tex.year, ("Phys. Rev. (1998) 1",), "1998"),
        (tex.url, (r"see \url{http://a.b/c} or http://d.e",), "http://a.b/c"),
        (tex.authors, (r"A. Author, \emph{T}, 2000",), "A. Author,"),
        (tex.title, (r"A. Author \newblock A great title. \newblock Publisher",), "A great title"),
        (tex.title, (r"A. Author, \emph{T of it}, 2000",), "T of it"),
        (tex.publisher, (r"A \newblock T. \newblock Pub House, 2000.",), "Pub House, 2000"),
        (tex.plain, (r"\bf Roy, \label{x} {\em T}",), "Roy, T"),
        (tex.plain, (r"\emph{T} x",), "T x"),
        (tex.plain, (r"\emphasis \textit{A theme} \bibinfo{year}{1999} M\"uller",), "emphasis A theme 1999 Muller"),
        (tex.plain, (r", {\it Nature} {\bf 12}, (1999) & 3-4 {author} authors",), "Nature 12 , (1999) 3-4 authors"),
        (tex.plain, (r"Ñandú \newblock {\textsc Zürich}",), "Ñandú Zürich"),
        (tex.title, (r"A, \emph{The {DNA} code}, 2000",), "The DNA code"),
        (tex.title, (r"A, {\em On {\it nested {deep}} things}, 2000",), "On \\it nested deep things"),
        (lambda c: tex.year_and_rest(c)[1], ("Phys. (1998) 1 (1999)",), "Phys.  1 (1999)"),
        (lambda c: tex.year_and_rest(c)[1], ("Phys. 1",), "Phys. 1"),
        (ids.guess_preprint_id, ("arXiv:1234.5678",), "1234.5678"),
        (ids.guess_preprint_id, ("arXiv hep-th/0803.2868",), "0803.2868"),
        (ids.guess_preprint_id, ("http://arxiv.org/abs/1023.1242",), "1023.1242"),
        (ids.guess_preprint_id, ("see arXiv:math-ph/9902022 there",), "math/9902022"),
        (ids.guess_preprint_id, ("http://arxiv.org/abs/hep-th/9711162",), "hep-th/9711162"),
        (ids.guess_preprint_id, ("nothing here 12/1234567",), None),
        (ids.repair_preprint_id, ("math-ph1234567",), "math-ph/1234567"),
        (ids.repair_preprint_id, ("1024.1242",), "1024.1242"),
        (ids.repair_doi, ("1234/abc",), "10.1234/abc"),
        (ids.repair_doi, ("10:1234/abc",), "10.1234/abc"),
        (ids.repair_doi, ("10.1234/abc",), "10.1234/abc"),
        (ids.repair_doi, ("10.12345/abc",), "10.12345/abc"),
        (ids.repair_doi, ("hopeless",), None),
        (ids.guess_doi, ("see doi 10.1234/ab.c.",), "10.1234/ab.c"),
        (ids.doi_uri_part, ("10.1/a<b#c",), "10.1/a%3Cb%23c"),
        (ids.complete_last_page, ("1234", "8"), "1238"),
        (ids.page_range, ("1234", "1234"), "1234"),
        (ids.page_range, ("1234", "8"), "1234-1238"),
        (ids.work_type, ("conf-proc",), "ConferenceProceedings"),
        (ids.work_type, ("poem",), "Expression"),
        (ids.patent_id, ("US 5,123,456",), "us:5123456"),
        (ids.patent_id, ("WO 99/12345",), "wipo:12345"),
        (ids.patent_id, ("XX 1",), None),
        (ids.hyphenated, ("JournalArticle",), "journal-article"),
        (ids.id_from_path, ("a/b/0704.0001.gz",), "0704.0001"),
        (ids.preferred_id, (None, "7", "10.1/x", "f"), "pmc:7"),
        (dates.day_month_year, ("2004", "Mar", "7"), "07/03/2004"),
        (dates.day_month_year, ("2004", None, None), "01/01/2004"),
        (dates.day_month_year, (None, "Mar", "7"), None),
        (dates.iso_date, ("2004", "12", None), "2004-12-01"),
        (dates.month_number, ("Spring",), None),
        (urls.normal_url, ("[HTTP://Example.ORG:80]",), "http://example.org:80/"),
        (urls.normal_url, ("www.example.org./a b.",), "http://www.example.org/ab"),
        (urls.normal_url, ("http://http://x.org/",), "http://x.org/"),
        (urls.normal_url, ("http://",), None),
        (urls.doi_in_url, ("http://dx.doi.org/doi:10.1234/x",), "10.1234/x"),
        (similarity.text_similarity, ("abcd", "abcf"), 0.75),
        (similarity.integer_similarity, ("12a", "13"), 0.5),
        (similarity.integer_similarity, ("x", "13"), None),
        (similarity.author_similarity, ("Smith RJ, Doe A", "Smith R, Doe Anna"), 0.8),
        (similarity.author_similarity, ("Smith R, Doe Anna", "Smith RJ, Doe A"), 1.0),
        (similarity.author_similarity, ("Smith R", "Smith Q"), 0.5),
    ],
)
def test_golden(apply, f, args, want):
    got = apply(f, *args)
    assert got == pytest.approx(want) if isinstance(want, float) else got == want


def test_brace_groups():
    nested = r"{one {two \em three} four} {\em five {six}} seven"
    assert tex.braced(nested, 1, 1) == (r"one two \em three four", r" {\em five {six}} seven")
    assert tex.braced(nested, 1, 2) == ("five six", " seven")
    assert tex.braced(nested, 2, 1) == (r"two \em three", r" four} {\em five {six}} seven")


def test_brace_column(spark):
    row = spark.range(1).select(tex.parse_braces(F.lit("{a {b}} c"), F.lit(1), F.lit(1)).alias("x")).first().x
    assert (row.parsed, row.rest) == ("a b", " c")


def test_items_of_a_bibliography(spark):
    source = "x\\begin{thebibliography}{9}\n% gone\n\\bibitem[L1]{k1} A. One \\newblock First title. \\newblock Pub, (1999)\n\\bibitem{k2} B. Two, \\emph{Second} http://u.rl\n\\end{thebibliography}"
    one, two = spark.range(1).select(tex.citations(F.lit(source)).alias("c")).first().c
    assert (one.cite_order, one.label, one.key, one.year, one.authors, one.title) == (1, "L1", "k1", "1999", "A. One", "First title")
    assert (two.cite_order, two.label, two.key, two.url, two.title) == (2, None, "k2", "http://u.rl", "Second")


def test_audit_trail(spark):
    rows = [("12 (Pt 3)", None), ("12 Suppl 3", ""), ("12;3", None), ("12;3", "9"), ("−5\\", None), ("1", "Pt 2"), ("1", "4 Pt 1"), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, volume string, issue string")
    got = [(r.volume, r.issue, len(r.errors)) for r in audit.sanitize_issue(audit.sanitize_volume(df)).orderBy("i").collect()]
    assert got == [("12", "3", 1)] * 3 + [("12;3", "9", 0), ("-5", None, 2), ("1", "2", 1), ("1", "4", 1), (None, None, 0)]


def test_sanitizing_twice_changes_nothing(spark):
    df = spark.createDataFrame([("3;4", None, "HTTP://dx.doi.org/10.1234/x", None), ("5", "6", "nowhere", "1234/y"), (None, None, None, "bad")], "volume string, issue string, uri string, doi string")
    once = audit.sanitize_record(df)
    assert [r.doi for r in once.collect()] == ["10.1234/x", "10.1234/y", None]
    twice = audit.sanitize_record(once)
    assert [r.errors for r in once.collect()] == [r.errors for r in twice.collect()]


def test_distance(spark):
    a = {k: F.lit(v) for k, v in {"title": "A title", "year": "2000", "volume": "12", "author": "Smith RJ"}.items()}
    b = a | {"year": F.lit("1997"), "author": F.lit("")}
    row = spark.range(1).select(similarity.distance(a, a).alias("same"), similarity.distance(a, b).alias("ab"), similarity.distance(b, a).alias("ba"), similarity.distance({"doi": F.lit("x")}, {"doi": F.lit("y")}).alias("none")).first()
    assert row.same == pytest.approx(0) and row.ab == pytest.approx(row.ba) == pytest.approx(1.9 / (1.4 + 0.25) - 1) and math.isinf(row.none)


def test_month_steps(spark):
    steps = spark.range(1).select(dates.month_steps(F.lit("2001-01-01").cast("date"), F.lit("2001-03-10").cast("date")).alias("s")).first().s
    assert [(str(a), str(b)) for a, b in steps] == [("2001-01-01", "2001-01-31"), ("2001-02-01", "2001-02-28"), ("2001-03-01", "2001-03-10")]
