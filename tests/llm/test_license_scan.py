import random

from spendframe.llm import license_scan as S
from spendframe.llm.common import read_table

from .conftest import AWKWARD, SMALL


def brute(text, template, least=S.LEAST_COVERAGE):
    """Most words that a stretch of the text has in common with the template, in order, over
    all stretches of about its length."""
    words, own = S.words_at(text)[0], S.words_at(template)[0]
    best = 0
    for i in range(max(1, len(words))):
        part = words[i:i + len(own) + S.BAND]
        row = [0] * (len(own) + 1)
        for w in part:
            new = [0]
            for j, t in enumerate(own):
                new.append(max(row[j + 1], new[j], row[j] + (w == t)))
            row = new
        best = max(best, row[-1])
    return best if best >= least * len(own) else 0


def scan(spark, rows, **kw):
    return S.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), **kw).collect()


def test_documents_against_plain_search(spark):
    docs = read_table(spark, SMALL, "documents", "doc_id", "text")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = S.scan(docs).collect()
    lines = {k: S.TEMPLATES[k] for k in ("apache-2.0-line", "mit-line", "gpl-3-line", "cc-by-nc-4.0-line")}
    want = {(i, k) for i, t in rows.items() for k, line in lines.items() if t and line[:-1] in t}
    assert {(r.doc_id, r.template) for r in got if r.template in lines} == want
    for r in got:
        assert rows[r.doc_id][r.start:r.end] == S.TEMPLATES[r.template].rstrip(".")


def test_edited_templates_report_span_and_coverage(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for k, (name, text) in enumerate(S.TEMPLATES.items()):
        words = text.split()
        for edits in (0, 1, 3):
            if len(words) < 30 and edits:
                continue
            w = list(words)
            for _ in range(edits):
                w[rng.randrange(5, len(w) - 5)] = "changed"
            w.insert(len(w) // 2, "added words") if edits == 3 else None
            made = "some words before this\n" + " ".join(w) + "\nand words after it"
            rows.append((len(rows), made))
            want[len(rows) - 1] = (name, text)
    got = {}
    for r in scan(spark, rows):
        got.setdefault(r.doc_id, {})[r.template] = r
    for i, (name, text) in want.items():
        r = got[i][name]
        made = rows[i][1]
        assert r.matched_words == brute(made, text)
        assert made[:r.start] == "some words before this\n" and r.coverage >= 0.8


def test_unrelated_and_partial_texts(spark):
    half = " ".join(S.TEMPLATES["mit-text"].split()[:30])
    rows = [(1, "the license of the software is under the version of the work"), (2, half)]
    assert [r.template for r in scan(spark, rows)] == []
    assert {r.template for r in scan(spark, rows, least=0.3)} >= {"mit-text"}


def test_two_matches_of_one_template(spark):
    line = S.TEMPLATES["mit-line"]
    got = scan(spark, [(1, f"{line}\nother words of a text\n{line}")])
    assert [(r.template, r.start) for r in got] == [("mit-line", 0), ("mit-line", len(line) + 23)]


def test_awkward_rows(awkward, no_rows):
    assert S.scan(awkward).count() == 0
    assert S.scan(no_rows).count() == 0
    assert {i for i, _ in AWKWARD}
