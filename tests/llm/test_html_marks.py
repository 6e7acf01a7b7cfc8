"""Pages whose marks say little: forms round a page, headings with ids made of their words, links inside sentences, classes
made anew for each page."""

import json
import random

import pytest

from adjudica.llm import html_extraction as H


def own(i, k=30):
    return " ".join(f"w{i}x{j}" for j in range(k))


def read(pages):
    wrapper = H.decided(H.infer(pages))
    return [H.read(p, wrapper) for p in pages]


@pytest.mark.parametrize("n", [1, 12])
def test_a_form_round_the_page_is_no_form(n):
    pages = [f'<body><form id="aspnetForm" class="form"><div class=top><form class=search>find</form></div><div class=content><h1>Head {i}</h1><p>{own(i)}</p></div></form></body>' for i in range(n)]
    got = read(pages)
    assert all(t.endswith(f"Head {i}\n{own(i)}") for i, t in enumerate(got))
    small = [f"<article><p>{own(i)}</p><form><label>your mail</label></form></article>" for i in range(n)]
    assert read(small) == [own(i) for i in range(n)]


@pytest.mark.parametrize(
    "part",
    [
        '<h2 id="related-work">Related work</h2>', '<h2 id="advertising">Advertising</h2>', '<h3 id="social-impact">Social impact</h3>', '<h2 id="comments">Comments</h2>', '<p class="ad-hoc">An ad hoc rule</p>',
        '<blockquote class="pull-quote-comment">Said so</blockquote>', '<figcaption class="caption ad-free">A caption</figcaption>', '<p id="sponsor">Our sponsor</p>', '<td class="nav">in a table</td>',
    ],
)
def test_words_of_the_article_stay(part):
    pages = [f"<article><p>{own(i)}</p>{part}<p>end {i}</p></article>" for i in range(7)]
    inner = part[part.index(">") + 1 : part.rindex("<")]
    assert read(pages[:1]) == [f"{own(0)}\n{inner}\nend 0"]
    assert read(pages)[3] == f"{own(3)}\n{inner}\nend 3"


@pytest.mark.parametrize("link", ['<a class="share-link">the share link</a>', '<a class="ad-link" href=x>the share link</a>', "<span class=ad>the share link</span>", '<em id="banner">the share link</em>'])
def test_links_do_not_cut_a_sentence(link):
    assert read([f"<article><p>See {link} here.</p></article>"]) == ["See the share link here."]


def test_adverts_and_menus_still_go():
    page = f"<body><ul class=nav><li>Home</ul><p class=ad>buy</p><p class='advert x'>more</p><div class=ad-box>x</div><div id=comments><p>no</p></div><article><p>{own(1)}</p><p class=advertisement>buy</p></article></body>"
    assert read([page]) == [own(1)]


def made(r, i, depth=3):
    """A page whose class names are made anew, as style compilers do."""
    name = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEF") for _ in range(7))
    parts = "".join(f'<div class="{name()}"><p class="{name()}">{own(f"{i}y{k}", 12)}</p></div>' for k in range(depth + i % 4))
    return f'<body class="{name()}"><div class="{name()}"><nav>menu</nav></div><main class="{name()}"><h1 class="{name()}">Head {i}</h1>{parts}</main><div class="{name()}"><footer>f</footer></div></body>', depth + i % 4


def test_wrappers_do_not_grow_with_made_names():
    r = random.Random(4)
    pages, counts = zip(*(made(r, i) for i in range(400)), strict=True)
    sizes = []
    wrapper = None
    for i, page in enumerate(pages, 1):
        one = H.infer([page])
        wrapper = one if wrapper is None else H.both(wrapper, one)
        if i in (100, 200, 400):
            sizes.append(len(json.dumps(wrapper)))
    assert sizes[2] < 1.3 * sizes[0] and sizes[2] < 150_000, sizes
    told = H.decided(wrapper)
    for i in (0, 7, 399):
        assert H.read(pages[i], told) == "\n".join([f"Head {i}", *(own(f"{i}y{k}", 12) for k in range(counts[i]))])
