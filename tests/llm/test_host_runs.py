"""Runs of a host are counted over the whole host."""

from collections import Counter

import numpy as np

from stratalake.llm import html_main


def test_runs_far_apart_in_a_host_are_found(spark):
    rng = np.random.default_rng(5)
    notice = "this line stands on three pages of one large host only"
    own = [" ".join(f"w{x}" for x in rng.integers(0, 100_000, 60)) for _ in range(240)]
    far = {0, 120, 239}
    rows = [(i, f"http://h.org/{i}", f"<p>{t}</p>" + (f"<p>{notice}</p>" if i in far else "")) for i, t in enumerate(own)]
    rows += [(1000 + i, f"http://other{i}.org/", f"<p>{notice}</p>") for i in range(3)]  # other hosts do not count
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    for chunk in (1 << 20, 500):
        got = {r.page_id: r.text for r in html_main.extract(pages, chunk=chunk).collect()}
        assert got == dict(enumerate(own)) | {1000 + i: notice for i in range(3)}


def test_run_names_equal_the_suffixes():
    rng = np.random.default_rng(6)
    blocks = [html_main.Block(" ".join(map(str, rng.integers(0, 2, size))), False) for size in (3, 40, 60)]
    start, name = html_main.run_names(blocks, "h", run=5)
    words = [b.text.split(" ") for b in blocks]
    flat, block = sum(words, []), np.repeat(range(3), [len(w) for w in words])
    assert start.tolist() == [i for i in range(len(flat) - 4) if block[i] == block[i + 4]]
    runs = [tuple(flat[i : i + 5]) for i in start]
    assert len(set(runs)) == len(set(zip(runs, name.tolist()))) == len(set(name.tolist()))


def test_a_notice_within_articles_goes_and_copies_stay(spark):
    rng = np.random.default_rng(7)
    words = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 100_000, n))
    notice = "this line stands within many articles of the host and belongs to none"
    own = [words(60) for _ in range(30)]
    copied, near = words(80), [words(8) + " " + (body := words(90)) + " " + words(8), *(words(8) + " " + body + " " + words(8) for _ in range(4))]
    page = "<div>{bar}</div><article><h1>{own}</h1><p>{notice}</p></article>"
    bar = "a bar above all articles of the host that no name tells"
    rows = [(i, f"http://h.org/{i}", page.format(bar=bar, own=t, notice=notice if i % 5 == 0 else "x")) for i, t in enumerate(own)]
    rows += [(100 + i, "http://h.org/c", page.format(bar=bar, own=copied, notice=notice)) for i in range(6)]
    rows += [(200 + i, "http://h.org/n", page.format(bar=bar, own=t, notice="x")) for i, t in enumerate(near)]
    rows += [(300 + i, f"http://g{i}.org/", page.format(bar=bar, own=own[i], notice=notice)) for i in range(4)]  # other hosts do not count
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    wanted = {i: t if i % 5 == 0 else f"{t}\nx" for i, t in enumerate(own)} | {100 + i: copied for i in range(6)}
    wanted |= {200 + i: f"{t}\nx" for i, t in enumerate(near)} | {300 + i: f"{own[i]}\n{notice}" for i in range(4)}
    for chunk in (1 << 20, 500):
        assert {r.page_id: r.text for r in html_main.extract(pages, chunk=chunk).collect()} == wanted


def by_force(pages: list[list[html_main.Block]]) -> list[str]:
    """The main texts of the pages of one host by lists of words."""
    run = html_main.RUN

    def places(blocks):
        return [(b, i, tuple(w[i : i + run])) for b, w in enumerate(x.text.split(" ") for x in blocks) for i in range(len(w) - run + 1)]

    own = [[b for b in blocks if b.main] or blocks for blocks in pages]
    stands = Counter(r for blocks in pages for r in {r for *_, r in places(blocks)})
    votes: Counter = Counter()
    for blocks, mine in zip(pages, own):
        different = {r for *_, r in places(mine)}
        if 2 * sum(stands[r] > 1 for r in different) <= len(different):
            votes.update({r for *_, r in places(blocks)})
    texts = []
    for blocks, mine in zip(pages, own):
        count = votes if any(b.main for b in blocks) else stands
        gone = {(b, i + k) for b, i, r in places(mine) if count[r] >= html_main.PAGES for k in range(run)}
        left = [" ".join(w for i, w in enumerate(x.text.split(" ")) if (b, i) not in gone) for b, x in enumerate(mine)]
        texts.append("\n".join(x for x in left if x))
    return texts


def test_main_texts_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    lines = [" ".join(rng.choice(["a", "b", "c", "d", "e", "f"], rng.integers(3, 16))) for _ in range(40)]
    html: list[str] = []
    for i in range(120):
        body = "".join(f"<p>{lines[rng.integers(40)] if rng.random() < 0.25 else ' '.join(f'w{x}' for x in rng.integers(0, 9999, rng.integers(1, 30)))}</p>" for _ in range(rng.integers(1, 7)))
        body = html[rng.integers(len(html))].replace("w1", "v1") if html and rng.random() < 0.2 else body if rng.random() < 0.3 else f"<div>{lines[rng.integers(40)]}</div><article>{body}</article>"
        html.append(body)
    parsed = [html_main.blocks_of(x) for x in html]
    wanted = by_force(parsed)
    changed = sum(w != "\n".join(b.text for b in html_main.own_blocks(p)) for w, p in zip(wanted, parsed) if not html_main._is_open(p))
    assert changed > 10 and html_main.main_texts(parsed, []) == wanted
    pages = spark.createDataFrame([(i, "http://h.org/", x) for i, x in enumerate(html)], "page_id long, url string, html string").repartition(4)
    assert {r.page_id: r.text for r in html_main.extract(pages).collect()} == dict(enumerate(wanted))


def test_equal_runs_have_equal_anchors():
    rng = np.random.default_rng(9)
    blocks = [html_main.Block(" ".join(map(str, rng.integers(0, 3, size))), False) for size in (2, 8, 300, 300)]
    suffixes = html_main.Suffixes.of(blocks, "h")
    _, name = html_main.run_names(blocks, "h")
    anchors = suffixes.anchors()
    assert len(anchors) == len(name) and len(set(zip(name.tolist(), anchors.tolist()))) == len(set(name.tolist()))
    assert len(html_main.Suffixes.of(blocks[:1], "h").anchors()) == 0 == len(html_main.Suffixes.of([], "h").anchors())
