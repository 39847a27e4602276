"""Main text of pages and licence scans on small fixtures."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import html_main, licenses

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>
<!-- ad --><div class="ad">Buy now</div><div class="cookie-notice">We use cookies</div><article><h1>Head&amp;line</h1><p><b>One  two<br>three<p>{body}</p>
<aside>Related</aside><form><input>Sign up</form><ul><li>first<li>second</ul><table><tr><td>a<td>b</table><div class="comments"><p>Nice!</p></div></article>
<footer>&copy; x</footer></body></html>"""


def test_article_without_the_rest():
    page = PAGE.format(body="caf&eacute; &#8212; end")
    assert html_main.main_texts([html_main.blocks_of(page)], []) == ["Head&line\nOne two three\ncafé — end\nfirst\nsecond\na b"]


def test_broken_pages():
    for page in ("", "<", "<article", "<article><p>x", "a < b", "<!-- open", "<script>never closed", "<p title='>'>x</p>", "<div class=\"ad\">y<article><p>x"):
        texts = html_main.main_texts([html_main.blocks_of(page)], [])
        assert texts[0] == {"<": "<", "a < b": "a < b"}.get(page, "x" if "x" in page else ""), page


def test_repeated_runs_of_a_host_are_boilerplate(spark):
    body = "<html><body><p>{own}</p><p>{notice}</p></body></html>"
    rng = np.random.default_rng(1)
    notice = "this notice stands on every page of the host and says nothing"
    own = [" ".join(f"w{x}" for x in rng.integers(0, 10_000, 30)) for _ in range(12)]
    rows = [(i, f"http://h.org/{i}", body.format(own=t, notice=notice)) for i, t in enumerate(own)] + [
        (50, None, None), (None, "http://h.org/n", ""), (51, "http://other.org", body.format(own="alone here", notice=notice)), (51, "http://other.org", body.format(own="alone here", notice=notice)),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("__host", F.lit(1))
    for chunk in (1 << 20, 2000):
        got = {(r.page_id, r.text, r.n_chars) for r in html_main.extract(pages, chunk=chunk).collect()}
        wanted = {(i, t, len(t)) for i, t in enumerate(own)} | {(50, "", 0), (None, "", 0)}
        alone = "alone here\n" + notice
        assert got == wanted | {(51, alone, len(alone))}
    assert html_main.extract(pages.limit(0)).count() == 0


def test_copies_of_an_article_stay(spark):
    page = "<html><body><div>top bar of the site with quite a few words in it</div><main><p>" + "the same article text again and again for all " * 3 + "</p></main></body></html>"
    pages = spark.createDataFrame([(i, "http://h.org/a", page) for i in range(5)], "page_id long, url string, html string")
    assert {r.text for r in html_main.extract(pages).collect()} == {("the same article text again and again for all " * 3).strip()}


def test_repeated_tokens_equal_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        token, block = rng.integers(0, 3, 80), np.repeat(np.arange(8), 10)
        page = block // 2
        got = html_main.repeated_tokens(token, block, page, run=3, pages=2)
        wanted = np.zeros(80, bool)
        seen: dict = {}
        starts = [i for i in range(78) if block[i] == block[i + 2]]
        for i in starts:
            seen.setdefault(tuple(token[i : i + 3]), set()).add(page[i])
        for i in starts:
            if len(seen[tuple(token[i : i + 3])]) >= 2:
                wanted[i : i + 3] = True
        assert (got == wanted).all()


def test_rules_are_many_and_ordered():
    rules = licenses.rules()
    assert len(rules) > 300 and [r.priority for r in rules] == sorted(r.priority for r in rules)
    scanner = licenses.Scanner(rules, licenses.BASE)
    every = set(scanner.words)
    assert [x for *_, x in scanner.detections("licensed under the apache license, version 2.0.", every)] == ["apache-2.0"]
    assert [x for *_, x in scanner.detections("spdx-license-identifier: mit and released under the mit license", every)] == ["mit", "mit"]
    assert scanner.detections("permitted admit limits", every) == []


def spelled(pattern, rng) -> str:
    """A random text that the pattern matches."""
    out = []
    for op, arg in pattern:
        name = str(op)
        if name == "LITERAL":
            out.append(chr(arg))
        elif name == "BRANCH":
            out.append(spelled(arg[1][rng.integers(len(arg[1]))], rng))
        elif name == "SUBPATTERN":
            out.append(spelled(arg[3], rng))
        elif name == "MAX_REPEAT":
            out += [spelled(arg[2], rng) for _ in range(rng.integers(arg[0], min(int(arg[1]), arg[0] + 1) + 1))]
        elif name == "IN":
            kind, value = arg[rng.integers(len(arg))]
            out.append({"LITERAL": lambda: chr(value), "RANGE": lambda: chr(rng.integers(value[0], value[1] + 1)), "CATEGORY": lambda: str(rng.integers(10))}[str(kind)]())
        else:
            raise NotImplementedError(name)
    return "".join(out)


def test_keywords_hide_no_spelling_of_a_rule(spark, docs):
    rng = np.random.default_rng(8)
    rules = licenses.rules()
    scanner = licenses.Scanner(rules, licenses.BASE)
    texts = [spelled(re._parser.parse(r.pattern), rng) for r in rules for _ in range(12)]
    texts = [mark.format(t) for t, mark in zip(texts, ["{}", "\u201c{}\u201d", "x: {}.", "\u2014{}\u2014"] * len(texts))]
    for text, rule in zip(texts, [r for r in rules for _ in range(12)]):
        assert re.search(rule.pattern, text) and all(any(k in text for k in group.split("|")) for group in rule.keyword.split("&")), (text, rule)
    found = {r.doc_id: [tuple(x) for x in r.spans] for r in licenses.scan(docs(*enumerate(t.upper() if i % 2 else t for i, t in enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert found[i] == scanner.detections(text, set(scanner.words)) != [], text


def test_versions_and_identifiers(spark, docs):
    wanted = {
        "licensed under the GPLv3": "gpl-3.0", "licensed under GPL v3.0": "gpl-3.0", "Licensed under the GNU LGPLv2.1.": "lgpl-2.1", "released under AGPLv3": "agpl-3.0",
        "SPDX-License-Identifier: GPL-3.0-only": "gpl-3.0", "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0", "SPDX-License-Identifier: GPL-2.0+": "gpl-2.0",
        "SPDX-License-Identifier: LGPL-2.1-only": "lgpl-2.1", "SPDX-License-Identifier: AGPL-3.0-or-later": "agpl-3.0", "SPDX-License-Identifier: GFDL-1.3-only": "fdl-1.3",
        "SPDX-License-Identifier: Apache-2.0": "apache-2.0", "SPDX-License-Identifier: Apache-1.1": "apache-1.1", "SPDX-License-Identifier: MPL-2.0": "mpl-2.0",
        "SPDX-License-Identifier: EPL-2.0": "epl-2.0", "SPDX-License-Identifier: BSL-1.0": "boost-1.0", "SPDX-License-Identifier: BUSL-1.1": "bsl-1.1",
        "SPDX-License-Identifier: PostgreSQL": "postgresql", "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause", "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by,cc-by-sa",
        "under the \u201cMIT\u201d": "", "\u201cMIT License\u201d": "mit", "License: MPL-2.0": "mpl-2.0",
    }
    texts = list(wanted)
    got = {texts[r.doc_id]: r.labels for r in licenses.scan(docs(*enumerate(texts))).collect()}
    assert got == wanted


def test_base_places_equal_brute_force(spark, docs):
    rng = np.random.default_rng(6)
    pool = ["cc", "by", "CC-BY", "general", "public", "license", "All rights", "reserved", ".", "General Public License", "é", "x", "\n", "MIT License"]
    rows = [(i, " ".join(rng.choice(pool, 14))) for i in range(150)] + [(200, None), (201, ""), (None, "cc by"), (202, "cc by"), (202, "cc by"), (203, "w " * 600_000 + "all rights reserved")]
    found = licenses.scan(docs(*rows).withColumn("n_words", F.lit("clash"))).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found), key=repr)
    wanted = []
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        at = [(p, label) for phrase, label in licenses.BASE.items() for p in range(len(w)) if w[p : p + len(phrase.split())] == phrase.split()]
        wanted.append((i, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))))
    assert got == sorted(wanted, key=repr)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 for r in found)
    assert licenses.scan(docs((1, "x")).limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, kept",
    [
        ('<article class="post related-topic"><p>Body</p></article>', "Body"),
        ('<article id="ad-12 open-comments"><p>Body</p></article>', "Body"),
        ('<article class="post"><p>Body</p><article class="comment"><p>First!</p></article></article>', "Body"),
        ('<main><p>Body</p><article class="promo"><p>Buy</p></article></main>', "Body"),
        ('<article><p>Body</p><div class="related-topic"><p>More</p></div></article>', "Body"),
    ],
)
def test_only_whole_names_take_an_article_away(page, kept):
    from stratalake.llm.html_main import blocks_of

    assert [b.text for b in blocks_of(page)] == [kept]
