import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
from samples import EDGE, edge, nothing, shared, texts_of  # noqa: F401

from lineweft.llm import decontaminate, lattice, licences, quality, wrappers

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_hits(docs, items, window):
    known = collections.defaultdict(set)
    for item, text in items:
        words = WORD.findall(ascii_lower(text))
        n = min(window, len(words))
        for at in range(len(words) - n + 1 if words else 0):
            known[tuple(words[at : at + n])].add(item)
    out = {}
    for i, text in docs:
        words = WORD.findall(ascii_lower(text))
        hit, found = [False] * len(words), set()
        for n in {len(k) for k in known}:
            for at in range(len(words) - n + 1):
                if tuple(words[at : at + n]) in known:
                    hit[at : at + n] = [True] * n
                    found |= known[tuple(words[at : at + n])]
        out[i] = (len(words), sum(hit), sorted(found))
    return out


def test_decontamination_equals_brute_force(spark):
    texts = texts_of(7, 120)
    docs = list(enumerate(texts))
    items = [(f"i{n}", " ".join(t.split()[3:40]).upper()) for n, t in enumerate(texts[::9])]
    items += [("short", " ".join(texts[0].split()[:2])), ("one", texts[5].split()[0]), ("none", ""), ("null", None)]
    got = decontaminate.contaminated_words(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame(items, "item_id string, text string"),
    )
    assert {r.doc_id: (r.n_words, r.n_hit, list(r.items)) for r in got.collect()} == brute_hits(docs, items, 13)


def test_decontamination_edge_cases(spark, edge, nothing):
    items = spark.createDataFrame([(1, "same TEXT"), (None, "same"), (1, "same TEXT")], "item_id bigint, text string")
    got = decontaminate.contaminated_words(edge, items).collect()
    assert len(got) == len(EDGE)
    assert {(r.n_hit, tuple(r.items)) for r in got if r.doc_id == 4} == {(2, (1,))}
    assert {r.n_hit for r in got if r.doc_id in (1, 2, 7)} == {0}
    assert decontaminate.contaminated_words(nothing, items).count() == 0
    none = items.limit(0)
    assert {r.n_hit for r in decontaminate.contaminated_words(edge, none).collect()} == {0}


def test_classifier_learns_and_is_held_out(spark):
    good, bad = [f"plain words number {i} here" for i in range(80)], [f"$$$ !!! {i} ### @@@" for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(good + bad)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 80)) for i in range(160)], "doc_id bigint, quality int")
    rows = quality.quality_scores(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert held and all((r.score >= 0.5) == (r.doc_id < 80) for r in held)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_rows_of_one_id_teach_alike_in_any_order(spark):
    rows = [(i % 20, f"text {i} {'good news' if i % 20 < 10 else 'bad words'}") for i in range(60)]
    rows += [(i, f"{'bad words' if i < 10 else 'good news'} again") for i in range(20)]
    labels = spark.createDataFrame([(i, int(i < 10)) for i in range(20)], "doc_id bigint, quality int")
    one, two = (
        {(r.doc_id, r.score) for r in quality.quality_scores(spark.createDataFrame(x, "doc_id bigint, text string"), labels).collect()}
        for x in (rows, rows[::-1])
    )
    assert one == two


def test_held_out_labels_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"text {i} {'good' if i % 2 else 'bad'}") for i in range(60)], "doc_id bigint, text string")
    right = [(i, i % 2) for i in range(60)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in right]
    one, two = (
        {r.doc_id: r.score for r in quality.quality_scores(docs, spark.createDataFrame(x, "doc_id bigint, quality int")).collect()}
        for x in (right, turned)
    )
    assert one == two


def test_classifier_edge_cases(spark, edge, nothing):
    labels = spark.createDataFrame([(3, 1), (7, 0), (None, 1), (9, None), (3, 0)], "doc_id bigint, quality int")
    assert quality.quality_scores(edge, labels).count() == len(EDGE)
    assert {r.score for r in quality.quality_scores(edge, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(nothing, labels).count() == 0


def paths_of(word, model):
    """Sum over all segmentations by enumeration."""
    marked = "▁" + word

    def below(at):
        if at == len(marked):
            return 1.0
        total = 0.0
        for end in range(at + 1, len(marked) + 1):
            weight = model.weights.get(marked[at:end])
            if weight is not None:
                total += math.exp(weight) * below(end)
        if model.weights.get(marked[at]) is None:
            total += math.exp(sum(model.byte_weights[b] for b in marked[at].encode())) * below(at + 1)
        return total

    return below(0)


def test_lattice_sums_all_segmentations():
    with open(PIECES, "rb") as file:
        model = lattice.Lattice.of(file.read(), np.arange(32000.0))
    for word in ("the", "lattice", "x", "naïve日", "\U0001f600a", ""):
        assert math.isclose(math.exp(model.log_probability(word)), paths_of(word, model), rel_tol=1e-9)


def test_language_model_counts_and_sums(spark):
    rows = list(enumerate(texts_of(8, 80)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    results = [
        {r.doc_id: r for r in lattice.score_texts(docs, PIECES, shipped_words=n).collect()} for n in (5, 10_000)
    ]
    tokens = {i: [*ascii_lower(t).split(), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    counts = collections.Counter(w for i in tokens if not held[i] for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    for i, words in tokens.items():
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        for found in results:
            r = found[i]
            assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(words), n)
            assert r.n_known == sum(counts[w] > 0 for w in words)
            assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(results[0][i].score, results[1][i].score, rel_tol=1e-9)


def test_language_model_edge_cases(edge, nothing):
    rows = lattice.score_texts(edge, PIECES).collect()
    assert len(rows) == len(EDGE) and all(r.score < 0 and r.n_tokens >= 1 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {1}
    assert lattice.score_texts(nothing, PIECES).count() == 0


def test_licences(spark, edge, nothing):
    texts = [
        "Copyright (c) 2020 Someone\nreleased under the  mit LICENCE",
        "Prose.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License!",
        "Released under the MIT License and more.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.whole_licence, list(r.licences), r.n_lines) for r in licences.licence_scan(docs).collect()}
    assert got == {0: ("MIT", ["MIT"], 1), 1: (None, ["CC-BY-NC-4.0", "MIT"], 2), 2: (None, [], 0)}
    assert licences.licence_scan(edge).count() == len(EDGE)
    assert licences.licence_scan(nothing).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met:

{0} Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer.
{1} Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the distribution.
{2}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
NEITHER = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
APACHE_HEADER = """Copyright 2021 Some Organisation

Licensed under the Apache Licence, Version 2.0 (the "Licence");
you may not use this file except in compliance with the Licence.
You may obtain a copy of the Licence at

    https://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the Licence is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the Licence for the specific language governing permissions and
limitations under the Licence."""


def test_whole_licence_documents(spark):
    copyright = "Copyright (c) 2011-2024 Somebody\n\n"
    two, three = BSD_TEXT.format("1.", "2.", ""), BSD_TEXT.format("*", "*", "\n* " + NEITHER + "\n")
    whole = [
        ("MIT", MIT),
        ("MIT", "The MIT Licence (MIT)\n\n" + copyright + MIT),
        ("MIT", "MIT License\n\n" + copyright + MIT.upper()),
        ("BSD-2-Clause", copyright + "All rights reserved.\n\n" + two),
        ("BSD-3-Clause", "BSD 3-Clause License\n\n" + copyright + three.replace("\n", " \r\n")),
        ("Apache-2.0", APACHE_HEADER),
    ]
    for name in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "Zlib", "Unlicense", "ISC", "BSL-1.0", "CC0-1.0"):
        text = max((t for n, t in licences.KNOWN if n == name), key=len)
        assert len(text) > 600
        whole.append((name, copyright + "  " + text.upper().replace("LICENSE", "LICENCE").replace("\n", "\n   ")))
    lines = [("GPL-2.0-only", "// SPDX-License-Identifier: GPL-2.0-only"), ("MPL-2.0", "Released under the Mozilla Public Licence 2.0.")]
    others = [MIT + "\nNot for use in aeroplanes.", MIT.replace("free of charge", "for a fee")]
    texts = [t for _, t in whole] + ["Prose.\n" + t for _, t in lines] + others
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.whole_licence, list(r.licences)) for r in licences.licence_scan(docs).collect()}
    expected = [(n, [n]) for n, _ in whole] + [(None, [n]) for n, _ in lines] + [(None, [])] * len(others)
    assert [(got[i][0], [n for n in got[i][1] if n == e[0]] if e[0] else got[i][1]) for i, e in enumerate(expected)] == expected


PAGE = (
    "<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href=x>Home</a></ul></nav>"
    "<div class='ad'>Buy</div><article><h1>Head &amp; {n}</h1><p><b>One.<br><p>Two  words\n here</p>{more}"
    "<div class=comments><p>Nice!</p></div></article><footer>&copy; host</footer><script>var a='</p>'</script>"
)


def test_extraction(spark):
    rows = [(n, f"http://h{n % 2}.org/{n}", PAGE.format(n=n, more="<p>More &lt;x&gt;</p>" * n)) for n in range(6)]
    rows += [(None, None, None), (7, "http://h0.org/", ""), (8, "odd", "<p>alone</p>"), (9, "odd", "no tags")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    inferred = wrappers.infer_wrappers(pages)
    got = {(r.page_id, r.url): r.text for r in wrappers.extract(pages, inferred).collect()}
    assert len(got) == len(rows)
    for n in range(6):
        assert got[n, f"http://h{n % 2}.org/{n}"] == "\n".join([f"Head & {n}", "One.", "Two words here", *["More <x>"] * n])
    assert got[None, None] == got[7, "http://h0.org/"] == ""
    assert got[8, "odd"] == "alone"
    empty = pages.limit(0)
    assert wrappers.extract(empty, wrappers.infer_wrappers(empty)).count() == 0


def extracted(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    return {r.page_id: r.text for r in wrappers.extract(pages, wrappers.infer_wrappers(pages)).collect()}


def sentences(n, k):
    return [f"sentence {k} of page {n} with word{n * 31 + k * 7} " + "and more " * (k + 1) + "here" for k in range(k)]


LINKED = (
    '<html><body><ul class=x><li><a href=a>One entry</a><li><a href=b>Another entry</a></ul><div class="{c}">{p}</div></body></html>'
)


def test_extraction_of_mixed_layouts(spark):
    def page(n, kind):
        paragraphs = "".join(f"<p>{s}</p>" for s in sentences(n, 4))
        if kind == "article":
            return f"<body><div class=a><article>{paragraphs}</article></div></body>"
        return LINKED.format(c=kind, p=paragraphs)

    kinds = ["article"] * 6 + ["story"] * 2 + ["text"]
    rows = [(n, "http://hot.org/", page(n, kind)) for n, kind in enumerate(kinds * 2)]
    rows += [(100 + n, f"http://none.org/{n}", page(n, kind)) for n, kind in enumerate(["story"] * 7 + ["text"])]
    rows += [(200 + n, url, page(n, kind)) for n, (url, kind) in enumerate([(None, "article"), (None, "text"), ("odd", "story")])]
    got = extracted(spark, rows)
    for i, _, _ in rows:
        assert got[i] == "\n".join(" ".join(s.split()) for s in sentences(i % 100, 4)), i


def test_words_of_inline_links_stay(spark):
    def page(n):
        one, two = sentences(n, 2)
        return LINKED.format(c="story", p=f'<p>{one} <a href="x">linked words</a> follow.</p><p><a href="y">Start</a> {two}</p>')

    got = extracted(spark, [(n, "http://h.org/", page(n)) for n in range(4)])
    for n in range(4):
        one, two = (" ".join(s.split()) for s in sentences(n, 2))
        assert got[n] == f"{one} linked words follow.\nStart {two}"


def test_wrappers_fold_and_align():
    trees = [wrappers.page_wrapper(wrappers.page_tree(x)) for x in (
        "<ul><li>a<li>b<li>c</ul><p>x</p>", "<ul><li>a</ul><h2>s</h2><p>x</p><h2>s</h2><p>y</p>"
    )]
    assert trees[0].expression() == "(ul(li(#)+) p(#))"
    whole = wrappers.merged(*trees)
    assert "li(#)+" in whole.expression() and "?" in whole.expression()


def test_word_windows_are_of_content_only():
    from lineweft.llm.words import window_hashes

    words = np.array([5, 6, 7, 5, 6, 7, 8], np.uint64)
    for length in range(1, 8):
        found = window_hashes(words, length)
        keys = [tuple(words[a : a + length].tolist()) for a in range(len(words) - length + 1)]
        assert len(set(found.tolist())) == len(set(keys)) and len(found) == len(keys)


def test_texts_do_not_depend_on_the_number_of_pages(spark):
    def page(n, words):
        paragraphs = "".join(f"<p>{s}</p>" for s in words)
        return f"<body><article><h2>Method</h2>{paragraphs}<p>All pages   say this.</p></article></body>"

    rows = [(n, "http://h.org/", page(n, sentences(n, 3))) for n in range(8)]
    rows += [(100 + n, "http://copies.org/", page(n, sentences(0, 3))) for n in range(8)]
    rows += [(200 + n, "http://few.org/", page(n, sentences(n, 3))) for n in range(3)]
    got = extracted(spark, rows)
    own = lambda n: "\n".join(" ".join(s.split()) for s in sentences(n, 3))
    for n in range(8):
        assert got[n] == f"Method\n{own(n)}\nAll pages say this."
        assert got[100 + n] == f"Method\n{own(0)}\nAll pages say this."
    for n in range(3):
        assert got[200 + n] == f"Method\n{own(n)}\nAll pages say this."


def test_template_texts_are_known_to_the_wrapper(spark):
    rows = [(n, "http://h.org/", f"<article><p>Pass it on!</p><p>own {n}</p></article>") for n in range(6)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    (found,) = wrappers.infer_wrappers(pages).collect()
    assert found.template == [f"{wrappers.text_hash('Pass it on!')} /article/p"]


def test_deeply_nested_pages_cost_no_other_page(spark):
    deep = "<div>" * 100_000 + "<p>at the bottom</p>" + "<nav><ul><li>menu</ul></nav>" + "</div>" * 50_000 + "<p>half up</p>"
    rows = [
        (1, "http://h.org/", "<article><p>good</p></article>"),
        (2, "http://h.org/", f"<article><p>top</p>{deep}</article>"),
        (3, "http://h.org/", "<article>" + "<b>" * 20_000 + "bold"),
        (4, "http://h.org/", "<article><p>x</p>" + "<ul><li>" * 3_000 + "item" + "</ul>" * 3_000 + "<p>y</p></article>"),
    ]
    assert extracted(spark, rows) == {1: "good", 2: "top\nat the bottom\nhalf up", 3: "bold", 4: "x\nitem\ny"}


def test_names_of_boxes_and_names_of_contents(spark):
    kept = ["share-price", "widget-review", "history", "adriatic"]
    dropped = ["share", "social-links", "top-menu", "ad_slot", "cookie-consent", "comment-list", "newsletter-signup-form"]
    html = "".join(f'<div class="{c}">{c}</div>' for c in kept + dropped)
    assert extracted(spark, [(1, "http://h.org/", f"<article>{html}</article>")]) == {1: "\n".join(kept)}


def test_words_of_many_texts_at_once():
    import pyarrow as pa
    import xxhash

    from lineweft.llm import words

    rng = random.Random(4)
    signs = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", " ", "A", "b", "é", "日", "0", "-", "  "]
    values = [None, "", "   ", "x", *("".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(300))]
    for table in (None, words.LOWER, words.LOWER_ALNUM):
        expected = [[xxhash.xxh3_64_intdigest(w) for w in ((v or "").encode().translate(table) if table else (v or "").encode()).split()] for v in values]
        whole = pa.record_batch({"text": pa.array(["before", *values])})
        for batch in (whole, whole.slice(1)):
            got = [x.tolist() for x in words.hashed_texts(batch, table)]
            assert got[-len(values) :] == expected
            runs = [s.to_pylist() for s in words.slices(batch, text_bytes=1)]
            assert sum(runs, []) == batch.column("text").to_pylist() and all(sum(bool(t) for t in run) <= 1 for run in runs)
    assert list(words.hashed_texts(whole.slice(0, 0))) == []
