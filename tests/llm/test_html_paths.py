"""Pages whose text is, is not, or is only partly in an article."""

import random
import time
from collections import defaultdict
from html.parser import HTMLParser

from folioflow.llm import html_paths


def paragraphs(n, what="Body"):
    return [f"{what} {i}, " + "with words, and more of them; so it goes on and on for a while. " * 4 + "End." for i in range(n)]


def test_main_text_beside_card_articles():
    body, cards = paragraphs(10), "".join(f"<article><h3><a href=/{i}>Card {i}</a></h3><p>Short teaser {i}.</p></article>" for i in range(6))
    content = "<div class=content><h1>Title</h1>" + "".join(f"<p>{x}</p>" for x in body) + "</div>"
    for page in (f"{content}<div>{cards}</div>", f"<div>{cards}</div>{content}", f"<main>{content}{cards}</main>", content + cards + "<div><p>Write to us.</p></div>"):
        got = html_paths.extract(f"<html><body>{page}</body></html>").split("\n")
        assert [x for x in got if x != "Write to us."] == ["Title", *body]


def test_main_text_without_article():
    body = paragraphs(5)
    page = "<div><ul><li><a href=/>Home</a></li></ul></div><div><h1>Title</h1><section>" + "".join(f"<p>{x}</p>" for x in body[:3]) + "</section><h2>Next</h2><section>" + "".join(f"<p>{x}</p>" for x in body[3:]) + "</section></div>"
    assert html_paths.extract(page) == "\n".join(["Title", *body[:3], "Next", *body[3:]])


def test_main_text_with_nested_body():
    body, title = paragraphs(10), "A heading of some forty letters, no more"
    page = f"<article><h1>{title}</h1><div>" + "".join(f"<p>{x}</p>" for x in body) + "</div></article>"
    assert html_paths.extract(page) == "\n".join([title, *body])
    assert html_paths.extract(f"<main><div>{page}</div><p>Beside it.</p></main>") == "\n".join([title, *body])


def test_main_text_of_several_articles_and_text_beside_an_article():
    posts = paragraphs(4, "Post")
    page = "<div><p>Our site.</p></div>" + "".join(f"<article><h2>Post {i}</h2><div><p>{x}</p></div></article>" for i, x in enumerate(posts))
    assert html_paths.extract(page) == "\n".join(line for i, x in enumerate(posts) for line in (f"Post {i}", x))
    body, more = paragraphs(8), paragraphs(6, "More")
    page = "<article>" + "".join(f"<p>{x}</p>" for x in body) + "</article><div>" + "".join(f"<p>{x}</p>" for x in more) + "</div><div><span>Small print</span></div>"
    assert html_paths.extract(page) == "\n".join([*body, *more])


def test_scores_decide(monkeypatch):
    body = paragraphs(6)
    page = "<body><div>Buy two, get one.</div><div><h1>Title</h1>" + "".join(f"<p>{x}</p>" for x in body) + "</div><div><span>Small print</span></div></body>"
    assert html_paths.extract(page) == "\n".join(["Title", *body])
    real = html_paths.path_scores
    monkeypatch.setattr(html_paths, "path_scores", lambda p: dict.fromkeys(real(p), 1.0))
    assert html_paths.extract(page) == "\n".join(["Buy two, get one.", "Title", *body, "Small print"])


def test_class_names_are_a_prior_only():
    body = paragraphs(4)
    plain = "".join(f"<p>{x}</p>" for x in body)
    assert html_paths.extract(f'<article>{plain}<p class="social-history">Its social history.</p></article>').endswith("Its social history.")
    assert html_paths.extract(f'<article>{plain}<div class="comment-list"><p>{body[0]}</p></div></article>') == "\n".join(body)
    # a page whose whole text is doubtful keeps it
    assert html_paths.extract(f'<div class="widget content">{plain}</div>') == "\n".join(body)


def test_attribute_values():
    assert html_paths.extract("<p>It's <a href=x title=it's>text</a> and more</p><p>Second paragraph, isn't it.</p>") == "It's text and more\nSecond paragraph, isn't it."
    assert html_paths.extract("<p title='a > b' data-x=\"c > d\" hid=den>One, two.</p><p hidden>No.</p><p data-class=nav>Three, four.") == "One, two.\nThree, four."


def test_deep_pages_take_linear_time():
    began = time.time()
    assert html_paths.extract("<div>" * 100_000 + "Text, at last.") == "Text, at last."
    assert len(html_paths.extract("<li><div>" * 20_000 + "<td>x, </td>" * 20_000)) > 0
    assert time.time() - began < 10


class Brute(HTMLParser):
    """The path table of well-formed pages by the standard parser."""

    def __init__(self):
        super().__init__()
        self.path, self.sums, self.link = [], defaultdict(lambda: [0, 0, 0, 0]), 0

    def handle_starttag(self, tag, attrs):
        self.link += tag == "a"
        if tag != "a":
            self.path.append(tag)

    def handle_endtag(self, tag):
        self.link -= tag == "a"
        if tag != "a":
            self.path.pop()

    def handle_data(self, text):
        s = self.sums["/".join(self.path)]
        s[0] += len(text)
        s[1] += sum(text.count(c) for c in ".,;:!?")
        s[2] += len(text) * (self.link > 0)
        s[3] += 1


def test_path_table_against_brute_force():
    rng = random.Random(3)

    def element(depth):
        if depth == 0 or rng.random() < 0.3:
            text = "".join(rng.choice("ab,.;") for _ in range(rng.randint(1, 30)))
            return f"<a href=/>{text}</a>" if rng.random() < 0.2 else text
        return "".join(f"<{t}>{element(depth - 1)}</{t}>" for t in rng.choices(["div", "section", "h2", "blockquote", "article"], k=rng.randint(1, 4)))

    for _ in range(40):
        text = f"<html><body>{element(5)}</body></html>"
        brute = Brute()
        brute.feed(text)
        page = html_paths.Page(text)
        names = {0: ""}
        for (parent, tag, _), number in page.paths.items():
            names[number] = f"{names[parent]}/{tag}" if parent > 0 else tag
        assert {names[p]: s for p, s in html_paths.path_table(page).items()} == dict(brute.sums)
