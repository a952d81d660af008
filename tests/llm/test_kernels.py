"""Exact comparisons of the numpy kernels with brute force."""

import time

import numpy as np
import pytest

from plumeworks.llm import coder, cover_tree, hamming, minhash, mixing, packing, pages, tokens


def test_coder_round_trip_and_damage():
    rng = np.random.default_rng(0)
    for ids in (np.zeros(0, int), np.array([7]), np.zeros(5000, int), rng.integers(0, 65536, 5000), rng.zipf(1.3, 5000) % 50000):
        data = coder.encode(ids, block=512)
        assert (coder.decode(data) == ids).all()
    broken = bytearray(data)
    broken[-20] ^= 255
    with pytest.raises(ValueError):
        coder.decode(bytes(broken))


@pytest.mark.parametrize("text", ["", "a  b", "a   b", " a", "a \n b", "a\n ", "<|endoftext|> x", "é  ü\tx", "foo, bar. don't &&& x&&& 12,5"])
def test_word_cache_equals_whole_encoding(text):
    path = tokens.default_path()
    whole = np.array(tokens.tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert tokens.encode_texts([text, None], path, b"")[0] == whole


@pytest.mark.parametrize("text", [
    "of.\nThe a\n\nb\n\n\nc\n", "\n\nx \n", "a\t\nb \tc,\xa0d", "\n\tx\n y", "\xa0b, \xa0b", "don't\n'tis, (x) _a_", "\u0120a \u0120\n\u0120a,", "x\u00b23 12.5\n3.", "\u6f22\u5b57, \ud55c\uad6d\n\u0939\u093f"])
def test_cuts_at_line_breaks_equal_whole_encoding(text):
    path = tokens.default_path()
    whole = np.array(tokens.tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert [tokens.encode_texts([text, text + " x"], path, b"")[0] for _ in range(2)] == [whole] * 2


def test_line_starts_and_marked_words_are_met_as_known_words(monkeypatch):
    """Words of letters go to the model as they are; a word is learned once, whatever punctuation or line break stands beside it."""
    asked = []
    tokens.forget()
    monkeypatch.setattr(tokens, "_encode_letters", lambda words, path, own=tokens._encode_letters: (asked.extend(words), own(words, path))[1])
    for text in ("x abcabc, abcabc.\nAbcabc", "x abcabc! abcabc\nAbcabc,"):
        tokens.encode_texts([text], tokens.default_path(), b"")
    assert sorted(asked) == ["\nAbcabc", "abcabc"]


def test_best_fit_equals_one_piece_at_a_time():
    rng = np.random.default_rng(1)
    for cap in (10, 64, 1024):
        counts = {int(k): int(rng.integers(1, 20)) for k in rng.choice(np.arange(1, cap + 1), 10, replace=False)}
        fill = {}
        for size, lo, hi, per, first, at in packing.best_fit(counts, cap):
            for k in range(hi - lo):
                fill.setdefault(first + k // per, []).append((at + k % per * size, size))
        bins = []
        for size in sorted(counts, reverse=True):
            for _ in range(counts[size]):
                fits = [k for k in range(len(bins)) if bins[k] >= size]
                if fits:
                    bins[min(fits, key=lambda k: bins[k])] -= size
                else:
                    bins.append(cap - size)
        assert len(fill) == len(bins)
        for places in fill.values():
            places.sort()
            assert [a for a, _ in places] == [sum(s for _, s in places[:k]) for k in range(len(places))]
    assert packing.best_fit({}) == []


def test_cover_trees_find_every_link():
    rng = np.random.default_rng(2)
    for spread in (0.001, 0.05, 0.5):
        x = rng.normal(size=(3, 8))[rng.integers(0, 3, 200)] + rng.normal(size=(200, 8)) * spread
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= 0.95
        np.fill_diagonal(near, False)
        assert (cover_tree.dual_links(cover_tree.Tree(x, 0.04), None, np.ones(200, int), 0.95).degree == near.sum(1)).all()
        near[:90, :90] = near[90:, 90:] = False
        both = cover_tree.dual_links(cover_tree.Tree(x[:90], 0.04), cover_tree.Tree(x[90:], 0.04), np.ones(200, int), 0.95)
        assert (both.degree == near.sum(1)).all()


def test_hamming_search_equals_scan():
    rng = np.random.default_rng(3)
    for segments in (1, 4, 8):
        code = rng.integers(0, 1 << 16, (300, segments)).astype(np.uint16)
        code[:100] &= np.uint16(0xFF0F)
        ids = rng.permutation(300) * 2
        q, near, far = hamming.search_block(ids, code, ids[:5], code[:5], 10)
        for k in range(5):
            scan = sorted((int(np.bitwise_count(code[i] ^ code[k]).sum()), int(ids[i])) for i in range(300) if i != k)[:10]
            assert sorted(zip(far[q == k].tolist(), near[q == k].tolist())) == scan


def test_signatures_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(4)
    agree = []
    for _ in range(40):
        e = np.sort(rng.integers(0, 2**63, 60).astype(np.uint64))
        m, n = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
        agree.append((minhash.signature(e, m) == minhash.signature(e, n)).mean() - minhash.similarity((e, m), (e, n)))
    assert abs(np.mean(agree)) < 0.03


def test_flight_holds_totals():
    rng = np.random.default_rng(5)
    size = np.sort(rng.integers(0, 900, 500))[::-1]
    p = mixing.flight(size, np.full(500, 0.3), 1)
    assert sum(0 < x < 1 for x in p) <= 2
    assert abs(np.dot(p, size) - 0.3 * size.sum()) < 1e-4 and abs(sum(p) - 150) < 1e-6
    assert set(mixing.flight(size, np.full(500, 0.3), 1, True)) <= {0.0, 1.0}


def test_page_text():
    page = (
        '<body><nav>Home</nav><div class="ad">Buy</div><article><h1>T &amp; U</h1><p>One, two,\n three words and some more text.<p><b>Bold'
        '<br>line<p>Short.</p></article><div class="comments"><p>I, too, think that this is a very fine article.</p></div><script>x="</p>"</script></body>'
    )
    assert pages.main_text(page) == "T & U\n\nOne, two, three words and some more text.\n\nBold line\n\nShort."
    assert pages.main_text(None) == pages.main_text("") == pages.main_text("<p>") == ""
    assert pages.main_text("plain  text &lt;") == "plain text <"


PARAGRAPHS = [f"Paragraph {k} of the article, long enough to score, says something of its own." for k in range(4)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)


@pytest.mark.parametrize("page", [
    f'<div class="content has-sidebar"><article>{BODY}</article><div class="sidebar"><p>Other news, all of it read by many people.</p></div></div>',
    f'<div class="sidebar"><article>{BODY}</article></div>',
    f'<div class="post comments-open">{BODY}</div><div id="comments"><p>I, too, think that this is a very fine article.</p></div>',
    f'<form action="/x"><input name="q"><div id="main">{BODY}</div><button>Go</button></form>',
    f'<div class="menu-left"><main>{BODY}<form><label>Your name</label></form></main></div>',
    f'<div class="social"><div class="text">{BODY}</div></div><div class="x"><p>One line of small print at the end.</p></div>',
    f'<div class="content">{BODY}</div><div class="related-posts"><a href="/1">Another article that is well worth reading</a></div>',
    f'<article>{BODY}<section id="comments"><article><p>I, too, think that this is a very fine article.</p></article></section></article>',
    f'<main><div class="content">{BODY}</div><section id="comments"><article><p>I, too, like this article.</p></article></section></main>',
])
def test_page_text_in_wrappers_named_like_furniture(page):
    assert pages.main_text(f"<html><body>{page}</body></html>") == "\n\n".join(PARAGRAPHS)


def test_page_text_keeps_sections_named_with_words_of_furniture():
    page = f'<article>{BODY}<h2 id="related-work">Related work</h2><p>Some.</p><h2 id="related">Related</h2><section id="social-impact"><p>It matters.</p></section></article>'
    assert pages.main_text(page) == "\n\n".join([*PARAGRAPHS, "Related work", "Some.", "Related", "It matters."])
    assert pages.main_text('<div class="notice">Closed today.</div>') == "Closed today."


def test_page_text_leaves_furniture_out_of_pages_without_paragraphs():
    for kind in ("article", "div"):
        page = f'<body><div class="ad">Buy this, it is cheaper than all the others.</div><{kind}><h1>Short one</h1><p>Few words.</p></{kind}></body>'
        assert pages.main_text(page) == "Short one\n\nFew words."


_P = "<p>" + "This is a sentence of an article, with commas, and words. " * 3 + "</p>"
_MENU = "<div class=menu><a href=x>Home</a> <a href=y>News</a></div>"


@pytest.mark.parametrize("page, times", [
    (f"<body>{_MENU}<div id=c><div class=row><div class=a>{_P * 4}</div></div><div class=row><div class=b>{_P * 4}</div></div></div><div class=foot>Copyright <a href=z>us</a></div>", 8),
    (f"<body>{_MENU}<div id=c><div class=a>{_P * 4}</div><div class=comments>{_P * 4}</div></div>", 4),
    (f"<body><div id=c><div><div class=a>{_P * 4}</div></div><div>" + "<a href=x>More of the same, and more of it, to read</a> " * 40 + "</div></div>", 4),
    (f"<body><div><div><div>{_P}</div></div><div><div>{_P * 3}</div></div><div><div>{_P * 2}</div></div></div>", 6),
])
def test_an_article_over_several_wrappers_is_whole(page, times):
    text = pages.main_text(page)
    assert text.count("This is a sentence") == 3 * times and "Home" not in text and "Copyright" not in text and "More of" not in text


def test_short_paragraphs_of_wide_scripts_score():
    page = "<body><div><a href=x>首页</a></div><div>" + "".join(f"<p>这是第{k}段很短的文字。</p>" for k in range(5)) + "</div>"
    assert pages.main_text(page) == "\n\n".join(f"这是第{k}段很短的文字。" for k in range(5))


@pytest.mark.parametrize("tags", ["<div>x ", "<span><b>y ", "<p><a href=z>w "])
def test_deep_pages_take_time_in_proportion(tags):
    start = time.time()
    pages.main_text(tags * 25_000)
    assert time.time() - start < 20
