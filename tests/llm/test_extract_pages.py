"""Pages whose articles were lost or cut: names, cards, unclosed elements, languages, deep nesting; neighbours against a plain search."""

import random
import time

import pytest

from tablelab.llm import extract

STORY = "The story of the town is that it was built on the river and in the hills by people from all over the land, who had come to it for the work that was there. " * 3
STORY = STORY.strip()


@pytest.mark.parametrize("names", ['class="layout no-sidebar"', 'class="post has-comments"', 'class="with-sidebar"', 'id="alert-page"', 'class="nav-layout"', 'class="header"'])
def test_names_that_say_something_else(names):
    assert extract.main_text(f"<body><div {names}><h1>Title of the page</h1><p>{STORY}</p><p>{STORY}</p></div></body>") == f"Title of the page\n\n{STORY}\n\n{STORY}"


@pytest.mark.parametrize("names", ['class="site-header"', 'class="sidebar-left"', 'class="comment-list"', 'id="cookieBanner"', 'class="x related"', 'class="wp-block share_buttons"'])
def test_names_that_are_out(names):
    assert extract.main_text(f"<body><div {names}><p>{STORY} Not this.</p></div><div><h1>Title</h1><p>{STORY}</p></div></body>") == f"Title\n\n{STORY}"


def test_many_comments_stay_out():
    page = f"<body><div><h1>Title</h1><p>{STORY}</p></div><div class='comments'>" + f"<p>{STORY} So I think.</p>" * 6 + "</div></body>"
    assert extract.main_text(page) == f"Title\n\n{STORY}"


def test_cards_beside_a_story_and_articles_that_hold_it():
    cards = "<article><h3><a href=x>Another story of the day</a></h3><p>What is in the other story of the day, and more of it for you.</p></article>" * 3
    assert extract.main_text(f"<body><div><h1>Title</h1><p>{STORY}</p><p>{STORY}</p></div>{cards}</body>") == f"Title\n\n{STORY}\n\n{STORY}"
    assert extract.main_text(f"<body><div><p>In the margin of the page is a line that is not of the story and out of it.</p></div><article><p>{STORY}</p></article></body>") == STORY


def test_unclosed_elements_end_with_the_next_block():
    for part in ("<button>Buy", "<select><option>a", "<map>", "<object>x", "<textarea>y"):
        assert extract.main_text(f"<body><div><p>{STORY}</p>{part}<p>{STORY} End.</p></div>") == f"{STORY}\n\n{STORY} End."
    assert extract.main_text(f"<body><p>{STORY}</p><button>Buy <b>now</b></button><p>{STORY}</p>") == f"{STORY}\n\n{STORY}"


def test_languages_without_a_list():
    text = (
        "A város története az, hogy a folyó mellett épült, és a hegyek között az emberek a munka miatt jöttek ide. Az utcák és a házak a régi "
        "időkből valók, de a tér és a kút újabb, és az emberek szeretik. A piac is a téren van, és ott mindig sokan vannak."
    )
    assert extract.main_text(f"<body><div><p>{STORY}</p><p>{text}</p></div>") == f"{STORY}\n\n{text}"


def test_deep_nesting_is_linear():
    def seconds(n):
        start = time.process_time()
        for page in ("<div>" * n + STORY + "</div>" * n, "<div><span class=ad>" * n + STORY, "<span class=ad>" * n + "<p>x</p>" * n, "<b class=ad></i>" * n):
            extract.main_text(page)
        return time.process_time() - start

    seconds(2000)
    assert seconds(32000) < 40 * seconds(2000) + 1
    assert extract.main_text("<div>" * 100_000 + STORY + "</div>" * 100_000) == STORY


def plain_second_pass(found, labels):
    """Neighbours looked for one by one."""
    out = []
    for i, b in enumerate(found):
        if labels[i] is not None:
            out.append(labels[i])
            continue
        rest = [j for j, o in enumerate(found) if not o.outside]
        place = rest.index(i)
        decided = [k for k, j in enumerate(rest) if found[j].container == b.container and labels[j] is not None]
        left, right = max((k for k in decided if k < place), default=None), min((k for k in decided if k > place), default=None)
        if left is None and right is None:
            words = extract.WORD.findall(b.text.lower())
            stop = sum(w in extract.STOP_WORDS for w in words) / len(words) if words else 0
            out.append(bool(b.container) or (stop >= extract.LEAST_STOP_ALONE and not b.linked) or (b.heading and not b.linked))
        elif b.container:
            out.append(True)
        else:
            near = right if left is None or (right is not None and right - place < place - left) else left
            out.append(labels[rest[near]])
    return [bool(x) for x in out]


def test_second_pass_against_a_plain_search():
    rng = random.Random(8)
    for _ in range(300):
        found, labels = [], []
        for _ in range(rng.randint(0, 14)):
            outside = rng.random() < 0.2
            found.append(extract.Block(rng.choice(["of the day", "Buy now", "12"]), rng.choice([0, 0, 5]), outside, rng.choice([0, 0, 1, 2]), rng.random() < 0.2))
            labels.append(False if outside else rng.choice([None, None, True, False]))
        assert extract.second_pass(found, labels) == plain_second_pass(found, labels)
