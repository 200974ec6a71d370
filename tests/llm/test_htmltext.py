"""Main-text extraction: pages of other makings than the training's, the LSTM against plain loops, its gradient against differences."""

import random

import numpy as np

from quaver.llm import htmltext

PAGE = "page_id long, url string, html string"
ENGLISH = "the house on the hill was old and nobody had lived there since the war but every summer people from town came up to see its garden which somebody still kept in good order they walked around it quietly".split()


def sentence(rng, low=6, high=25):
    return " ".join(rng.choice(ENGLISH) for _ in range(rng.randrange(low, high))).capitalize() + "."


def paragraphs(rng):
    return [" ".join(sentence(rng) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(3, 9))]


def blog(rng):
    """Containers whose names say nothing, links in a second column."""
    title, body = sentence(rng, 3, 8)[:-1], paragraphs(rng)
    links = "".join(f'<li><a href="/{k}">{rng.choice(ENGLISH).capitalize()}</a></li>' for k in range(rng.randrange(3, 9)))
    return f'<html><body><div id="wrap"><div id="col1"><h1>{title}</h1>{"".join(f"<p>{p}</p>" for p in body)}</div><div id="col2"><ul>{links}</ul></div></div></body></html>', [title, *body]


def old_school(rng):
    """Upper case, a table for layout, ends left out, unquoted values with quotes in them."""
    title, body = sentence(rng, 3, 8)[:-1], paragraphs(rng)
    menu = "<BR>".join(f"<A HREF=/{k}.htm>{rng.choice(ENGLISH)}</A>" for k in range(5))
    return f'<HTML><BODY BGCOLOR=white><TABLE><TR><TD CLASS=menu>{menu}</TD><TD CLASS=content><H1 TITLE=o\'clock>{title}</H1>{"".join(f"<P ALIGN=left>{p}" for p in body)}</TD></TR></TABLE></BODY></HTML>', [title, *body]


def news(rng):
    """Landmarks, a quote, a list, a caption in the text; related links and comments after it."""
    title, body, points = sentence(rng, 3, 8)[:-1], paragraphs(rng), [sentence(rng, 3, 9) for _ in range(3)]
    inner = f'<h1>{title}</h1><p>{body[0]}</p><ul>{"".join(f"<li>{x}" for x in points)}</ul>' + "".join(f"<p>{p}</p>" for p in body[1:-1]) + f"<blockquote>{body[-1]}</blockquote>"
    said = "".join(f'<div class="comment"><p>{sentence(rng)}</p></div>' for _ in range(3))
    return f'<!doctype html><title>x</title><header class="masthead"><a href="/">The Paper</a></header><nav><a href="/1">World</a> <a href="/2">Sport</a></nav><div class="cookie">We use cookies.</div><main><article>{inner}</article></main><aside><h3>Related</h3><ul><li><a href="/9">{sentence(rng, 3, 6)}</a></ul></aside><section class="comments">{said}</section><footer>&copy; 2020 The Paper</footer>', [title, body[0], *points, *body[1:]]


def test_pages_of_other_makings(spark):
    rng = random.Random(17)
    made = [make(rng) for make in (blog, old_school, news) for _ in range(30)]
    rows = htmltext.query(spark.createDataFrame([(k, "u", page) for k, (page, _) in enumerate(made)], PAGE)).collect()
    exact = [0, 0, 0]
    wrong = total = 0
    for r in rows:
        want, got = made[r.page_id][1], r.text.split("\n")
        exact[r.page_id // 30] += got == want
        wrong += len(set(got) ^ set(want))
        total += len(want)
    assert min(exact) >= 24 and wrong <= 0.03 * total, (exact, wrong, total)


def test_stray_quotes_end_no_page():
    for page, want in (
        ("<p title=don't>One.</p><p>It's two.</p>", ["One.", "It's two."]),
        ("<p a='1>2' b=\"x>y\">One.</p>", ["One."]),
        ("<a b=' >never closed", []),
        ("<p \"x>One.</p>'", ["One.", "'"]),
        ("<p a = 'v>w' c>One.</p>", ["One."]),
        ("<p a=>One.</p>", ["One."]),
        ("a<b c<p>d", ["ad"]),
    ):
        assert [b.text for b in htmltext.blocks(page)] == want, page


def test_where_blocks_begin():
    page = "<div> <b> One</b> two<p>three<br>four</div>"
    found = htmltext.blocks(page)
    assert [b.text for b in found] == ["One two", "three", "four"]
    assert [page[b.start :].lstrip()[:3] for b in found] == ["One", "thr", "fou"]


def plain_lstm(x, wx, wh):
    h = c = np.zeros(wh.shape[0])
    out = []
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    for row in x:
        i, f, o, g = np.split(row @ wx + h @ wh, 4)
        c = sigmoid(f) * c + sigmoid(i) * np.tanh(g)
        h = sigmoid(o) * np.tanh(c)
        out.append(h)
    return np.array(out)


def test_forward_step_by_step():
    rng = np.random.default_rng(3)
    model = htmltext.BiLSTM(rng)
    pages = [rng.standard_normal((n, htmltext.DIM)).astype(np.float32) for n in (1, 4, 7)]
    z, _ = model.forward(*htmltext.pad(pages))
    for row, x in zip(z, pages, strict=True):
        a = plain_lstm(x, model.p[0], model.p[1])
        b = plain_lstm(x[::-1], model.p[2], model.p[3])[::-1]
        want = (np.concatenate([a, b, x], 1) @ model.p[4])[:, 0]
        assert np.allclose(row[: len(x)], want, atol=1e-4)
    assert all((m == (z[k, : len(x)] > 0)).all() for k, (m, x) in enumerate(zip(model.main(pages), pages, strict=True)))


def test_gradient_against_differences():
    rng = np.random.default_rng(4)
    model = htmltext.BiLSTM(rng)
    model.p = [w.astype(np.float64) for w in model.p]
    x, lengths = htmltext.pad([rng.standard_normal((n, htmltext.DIM)) for n in (2, 5)])
    y = (rng.random(x.shape[:2]) < 0.5).astype(float)
    mask = np.arange(x.shape[1]) < lengths[:, None]

    def loss():
        z, _ = model.forward(x, lengths)
        return ((np.logaddexp(0, z) - y * z) * mask).sum() / mask.sum()

    for w, g in zip(model.p, model.gradients(x, lengths, y), strict=True):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in w.shape)
            keep = w[at]
            w[at] = keep + 1e-3
            up = loss()
            w[at] = keep - 1e-3
            down = loss()
            w[at] = keep
            assert np.isclose(g[at], (up - down) / 2e-3, rtol=2e-2, atol=2e-5)
