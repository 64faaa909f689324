"""Main-text extraction and the pipeline."""

import html
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairforge.llm import bpe, decontaminate as D, jaccard as J, substring as S, toxicity
from pairforge.llm.html_extract import Forest, Page, extract, hints_of
from pairforge.llm.html_pages import _LABEL, _Writer, default_model, labelled_page
from pairforge.sources.tables import table

from test_llm_set_ops import brute_links, brute_substring


def test_marginals_equal_enumeration():
    page = Page("<body><nav><a href=x>one</a></nav><article><h1>T</h1><p>Some text.</p></article></body>")
    m = default_model()
    forest = Forest([page], m.names, m.kinds)
    r = np.random.default_rng(0)
    w, edge = r.normal(size=len(m.w)), r.normal(size=m.edge.shape)
    p, pair, z = forest.marginals(w, edge)
    own = np.bincount(forest.node, w[forest.feat], forest.n)
    total, mass = 0.0, np.zeros(forest.n)
    for y in itertools.product((0, 1), repeat=forest.n):
        y = np.array(y)
        s = own @ y + sum(edge[forest.kind[k], y[forest.parent[k]], y[k]] for k in range(1, forest.n))
        total += np.exp(s)
        mass += np.exp(s) * y
    assert np.allclose(p, mass / total) and np.isclose(z, np.log(total))
    assert np.allclose(pair[1:].sum(axis=(1, 2)), 1)


def test_unseen_labelled_pages():
    m, bad = default_model(), 0
    for k in range(200):
        source = _Writer(5_000_000 + k).page()
        page, y = labelled_page(source)
        want = "\n".join(t for t, v in zip(page.text, y) if t is not None and v)
        bad += m.texts([_LABEL.sub("", source)])[0] != want
    assert bad <= 10


def test_pages_of_the_table(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "html")
    got = {r.page_id: r.text for r in extract(pages, default_model()).collect()}
    for r in pages.collect():
        a = r.html[r.html.index("<article>") + 9: r.html.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", a))
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("<p>", ""),
    ("<article><p>One\n two&nbsp;&amp; &lt;b&gt;<p>Three <b>four</b>.<script>x='</p>'</script></article>", "One two & <b>\nThree four ."[:0] + "One two & <b>\nThree four."),
    ("<article><h1>A title</h1><!-- <p>no</p> --><p>Some text here, and more.</p><form><p>Name</p><input></form></article><footer>&copy; x</footer>",
     "A title\nSome text here, and more."),
    ("<nav><a href=a>a</a><a href=b>b</a></nav><article><ul><li>First point here.<li>Second point here.</ul></article>", "First point here.\nSecond point here."),
    ("<article><p>Text 1 < 2 and a <i>mark</article>", "Text 1 < 2 and a mark"),
])
def test_markup_cases(source, want):
    assert default_model().texts([source]) == [want]


def test_deep_and_broken_pages_are_read(spark):
    deep = "<div>" * 3000 + "<p>Deep text, as it stands.</p>"
    rows = [(1, deep, "t"), (2, "<p class='x>y", "t"), (3, "<!-- open", "t"), (3, "<!-- open", "t"), (4, None, "t")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = extract(df, default_model()).collect()
    assert len(got) == 5 and next(r.text for r in got if r.page_id == 3) == ""
    assert extract(df.limit(0), default_model()).count() == 0


def test_pipeline_stages_against_brute_force(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "substring_dedup", "decontaminate", "bpe"]
    docs = table(spark, sf, "documents").cache()
    cols = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    # toxicity: what the scorer predicts toxic goes
    clean = toxicity.toxicity_stage(spark, docs, sf).cache()
    scores = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.learn(spark, docs, sf)).collect()}
    assert clean.columns == cols and {r.doc_id for r in clean.collect()} == {i for i, p in scores.items() if not p}
    assert 0 < len(rows) - clean.count() < 0.3 * len(rows)
    # Jaccard join: one document of each group
    kept = J.jaccard_stage(spark, clean, sf).cache()
    texts = sorted((r.doc_id, r.text) for r in clean.collect())
    want = {c for _, n, c, _ in brute_links(texts, 5, J.Threshold(80, 100))}
    assert kept.columns == cols and sorted(r.doc_id for r in kept.collect()) == sorted(want)
    # substring dedup: counts of removed words
    cut = S.substring_stage(spark, kept, sf).cache()
    brute = {i: (n, g) for i, n, g, _ in brute_substring(sorted((r.doc_id, r.text) for r in kept.collect()))}
    after = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == cols and set(after) == {i for i, (n, g) in brute.items() if not n or n > g}
    for i, r in after.items():
        assert len(r.text.encode().split()) == brute[i][0] - brute[i][1]
        assert r.text == rows[i].text if not brute[i][1] else r.n_chars == len(r.text)
    # decontamination: documents that hold an item's shingles go
    items = [(r.item_id, D.shingles(D.words_of(r.text))) for r in table(spark, sf, "benchmark").collect()]
    left = D.decontaminate_stage(spark, cut, sf).cache()
    dirty = {i for i, r in after.items() if (s := D.shingles(D.words_of(r.text))) and any(len(x & s) >= 0.6 * len(x) for _, x in items)}
    assert left.columns == cols and {r.doc_id for r in left.collect()} == set(after) - dirty
    # BPE: every text that is left
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.tokenizer_path())
    texts = {r.doc_id: r.text for r in left.collect()}
    for r in bpe.bpe_stage(spark, left, sf).collect():
        assert list(r.ids) == t.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_filtering_stages_keep_rows_of_odd_kinds(spark, sf):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "alpha beta gamma delta epsilon zeta", None, "s", 5),
            (3, "alpha beta gamma delta epsilon zeta", None, "s", 5), (4, "other words of no import", "en", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for f in (J.jaccard_stage, S.substring_stage, D.decontaminate_stage):
        out = f(spark, docs, sf)
        n = {J.jaccard_stage: 5}.get(f, 6)
        assert out.columns == docs.columns and out.count() == n, f
        assert f(spark, docs.limit(0), sf).count() == 0


STORY = "<h1>A title</h1><p>Some text here, and more of it.</p>"


@pytest.mark.parametrize("attrs, want", [
    (' aria-hidden="false" data-nav="hidden"', []), (' title="a hidden gem" data-class=nav', []), (" data-x='class=\"nav\"' href=a/hidden", []),
    (" hidden", ["hidden"]), (" CLASS=nav hidden=''", ["hidden", "nav"]), (' style="display: none"', ["hidden"]), (' title="a hidden class=nav', []),
])
def test_hints_come_from_whole_attributes(attrs, want):
    assert hints_of(attrs) == want


@pytest.mark.parametrize("source, more", [
    (f'<body data-nav="hidden"><article aria-hidden="false">{STORY}</article>', ""),
    (f'<body style="visibility:hidden"><article>{STORY}</article>', ""),
    (f"<article>{STORY}<div hidden><p>A section of the story, folded.</p></div></article>", "\nA section of the story, folded."),
    (f"<article>{STORY}<p>We see that <math><mi>x</mi> = <mn>2</mn></math> holds, as said.</p></article>", "\nWe see that x = 2 holds, as said."),
    (f"<article>{STORY}<svg><text>Figure text in words.</text></svg><object><p>An object text, shown.</p></object></article>",
     "\nFigure text in words.\nAn object text, shown."),
    (f"<article>{STORY}<dialog open><p>A dialog in the story, said.</p></dialog><xmp>a <b> c, shown.</xmp></article>", "\nA dialog in the story, said.\na <b> c, shown."),
    (f'<div hidden class="cookie-notice"><p>We use cookies, accept them.</p></div><article>{STORY}</article><dialog><p>Subscribe to our letter.</p></dialog>', ""),
])
def test_hidden_and_rare_elements_are_judged_by_the_model(source, more):
    assert default_model().texts([source]) == ["A title\nSome text here, and more of it." + more]
