"""Page blocks by their marks, and the alignment of pages' lines against a plain table."""

import random
import resource

import pytest

from aerolake.llm import blocks
from aerolake.llm.blocks import ARTICLE, common_lines, text_blocks


def article(html):
    return [t for t, region in text_blocks(f"<body><article><p>{'Main text here. ' * 20}</p>{html}</article></body>") if region == ARTICLE][1:]


@pytest.mark.parametrize("html", [
    '<div class="entry-header"><h1>Title</h1></div>', '<section class="share-prices"><p>Title</p></section>', '<div id="search-engines">Title</div>',
    '<div class="social-studies">Title</div>', '<h2 class="ad">Title</h2>', '<div class="header"><h1>Title</h1></div>', '<p data-class="ad">Title</p>'])
def test_names_that_only_hold_a_boilerplate_word_stay(html):
    assert article(html) == ["Title"]


@pytest.mark.parametrize("html", [
    '<p class="advert">Gone</p>', "<p>Kept <span hidden>Gone</span></p>", '<p>Kept <span class="ad">Gone <span>gone</span></span></p>',
    '<div class="comments"><p>Gone</p></div>', '<div role="complementary">Gone</div>', '<ul class="share-buttons"><li>Gone</li></ul>',
    '<p style="display: none">Gone</p>', '<li class="sponsored">Gone</li>', "<aside>Gone</aside>", '<p>Kept <b class="ad">Gone</p><p>Kept</p>'])
def test_marked_elements_go(html):
    assert all("one" not in t for t in article(html)) and article(html + "<p>after</p>")[-1] == "after"


def test_names_never_take_most_of_an_article():
    page = f'<body><article><p>Short.</p><div class="comments"><p>{"Long text. " * 50}</p></div></article></body>'
    assert len([t for t, r in text_blocks(page) if r == ARTICLE]) == 2


def plain_length(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


@pytest.mark.parametrize("bits", [1 << 24, 30])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(blocks, "ALIGNED_BITS", bits)
    draw = random.Random(8)
    for _ in range(300):
        a, b = ([draw.randrange(draw.choice([2, 5, 30])) for _ in range(draw.randrange(25))] for _ in range(2))
        lefts, rights = common_lines(a, b)
        assert len(set(lefts)) == len(lefts) == len(set(rights)) == len(rights) == plain_length(a, b)
        assert [a[i] for i in lefts] == [b[j] for j in rights]


def test_long_pages_are_aligned_in_little_memory():
    draw = random.Random(2)
    a = [draw.randrange(10**9) for _ in range(100_000)]
    b = [x for x in a if draw.random() < 0.5]
    b = [draw.randrange(10**9, 10**10) if draw.random() < 0.2 else x for x in b] + list(range(10**11, 10**11 + 50_000))
    kept = set(a)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    lefts, rights = common_lines(a, b)
    assert len(lefts) == sum(x in kept for x in b) and [a[i] for i in lefts] == [b[j] for j in rights]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000
