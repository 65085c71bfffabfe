import html as entities
import re

from sonomart.llm import html

PROSE = "The first of the paragraphs is one that has a lot of the common words in it, and so it is told to be good."


def test_marked_page():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><article>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></li></ul></nav><div id="cookie-notice">{PROSE}</div><!-- <p>no</p> -->
<article><h1>Title &amp; more</h1><p class="lead">{PROSE}<br>with&nbsp;a
  break &lt;b&gt;</p><p>Short.</p><p>ZZZ QQQ | {"xyzzy " * 40}</p><ul><li><a href=y>Related link of the page</a></li></ul><form><p>{PROSE}</p></form>
<div class="ad">{PROSE}</div><section id=comments><p>{PROSE}</p></section><div style="display: none">{PROSE}</div><p>Last</p></article>
<aside>{PROSE}</aside><footer>&copy; {PROSE}</footer></body></html>"""
    want = ["Title & more", f"{PROSE} with a break <b>", "Short.", "ZZZ QQQ | " + " ".join(["xyzzy"] * 40), "Last"]
    assert html.extract(page).split("\n") == want


def test_plain_page_inherits_labels():
    page = f"<div><h2>Head</h2><p>{PROSE}</p><p>Short one.</p><p>{PROSE}</p></div><div><p><a href=a>one link</a> <a href=b>two</a></p><p>Tail</p></div>"
    assert html.extract(page).split("\n") == ["Head", PROSE, "Short one.", PROSE]


def test_odd_input():
    assert [html.extract(x) for x in (None, "", "  ", "<p", "<!--", "<script>x", "<<>>&", "a<b>c</b>d")] == ["", "", "", "", "", "", "<<>>&", "acd"]
    assert html.extract("<p>" + "the " * 200_000) == ("the " * 200_000).strip()


def test_rows(spark):
    df = spark.createDataFrame([(2**60 + 1, "u", f"<p>{PROSE}", 1), (None, None, None, 2), (3, "v", "", 3), (3, "v", "", 3)],
                               "page_id long, url string, html string, n_chars int")
    got = sorted(map(tuple, html.extract_pages(df).collect()), key=str)
    assert got == sorted([(2**60 + 1, "u", PROSE, len(PROSE)), (None, None, "", 0), (3, "v", "", 0), (3, "v", "", 0)], key=str)
    assert html.extract_pages(df.limit(0)).count() == 0


def test_articles_of_the_given_pages(spark):
    from sonomart.llm.queries import op9_html, table
    path = "/root/testdata/sf0.01"
    got = {r.page_id: r.text for r in op9_html(spark, path).collect()}
    for r in table(spark, path, "pages").collect():
        body = r.html.partition("<article>")[2].partition("</article>")[0]
        parts = [" ".join(entities.unescape(re.sub("</?b>", "", p).replace("<br>", " ")).split()) for p in re.split("</?(?:p|h1)>", body)]
        assert got[r.page_id] == "\n".join(p for p in parts if p)


def test_skipped_elements_end():
    for icon in ('<svg class="i"/>', "<math/>", "<object>", "<canvas>", "<video src=x>", "<svg class=a>"):
        page = f"<article><p>{PROSE}</p>{icon}<p>{PROSE} Again.</p><svg><svg/><g><text>no</text></g></svg><p>{PROSE} Last.</p></article>"
        assert html.extract(page).split("\n") == [PROSE, f"{PROSE} Again.", f"{PROSE} Last."]
    assert html.extract(f"<p>{PROSE}</p><script><p>{PROSE}</p>") == PROSE


def test_class_pieces_on_wrappers():
    for tag in ('article class="post comments-open"', 'main class="has-sidebar"', 'main id="skip-target"', 'div class="layout has-sidebar"'):
        assert html.extract(f"<{tag}><p>{PROSE}</p></{tag.split()[0]}>") == PROSE
    assert html.extract(f"<article><p>{PROSE}</p></article><section id=comments><p>{PROSE * 5}</p></section>") == PROSE


def test_unmarked_pages_keep_articles():
    russian = "Это длинная статья о том, как люди живут и работают в большом городе, где много разных улиц и домов. " * 2
    assert html.extract(f"<ul><li><a href=x>Меню сайта</a></li></ul><p>{russian}</p><p><a href=y>Дальше</a></p>") == russian.strip()
    law = "The law of copyright is one that has a lot of rules in it, and so it is told to be hard to read for most of us."
    assert html.extract(f"<p>{law}</p><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p><p>© {PROSE}</p>").split("\n") == [law, PROSE, PROSE, PROSE]
    body = "\n".join([PROSE] * 4)
    assert html.extract("<div>" + f"<p>{PROSE}</p>" * 4 + f"</div><article><p>Short teaser.</p></article>").startswith(body)


def test_whole_names_decide_whatever_their_size():
    for name in ("class=comments", "id=sidebar", 'class="x comment-list"', "id=main-nav", "role=navigation", 'class="ad banner"'):
        page = f"<div><p>{PROSE}</p></div><div {name}><p>{PROSE * 3}</p><p>{PROSE * 3}</p></div>"
        assert html.extract(page) == PROSE, name


def test_parts_of_names_leave_blocks_to_their_neighbours():
    for name in ("share-price", "social-history", "notice-period", "ad-hoc", "has-sidebar"):
        page = f"<article><h1>Head</h1><p>{PROSE}</p><div class={name}><p>{PROSE} In.</p></div><p class={name}>{PROSE} At.</p><p>{PROSE} End.</p></article>"
        assert html.extract(page).split("\n") == ["Head", PROSE, f"{PROSE} In.", f"{PROSE} At.", f"{PROSE} End."]
        assert html.extract(f"<div class={name}><p>{PROSE}</p><p>{PROSE} Two.</p></div>").split("\n") == [PROSE, f"{PROSE} Two."]
    links = "<p><a href=x>a link that is long enough to count as a line of links</a></p>"
    assert html.extract(f"<p>{PROSE}</p>{links}<div class=share-price><p>{PROSE} X.</p></div>{links}") == PROSE


def test_quotes_open_strings_only_behind_the_equals_sign():
    page = f"<article><p>{PROSE}</p><img alt=Bob's><p>{PROSE} Two.</p><img alt=a\"b title='x > y'><p>{PROSE} It's.</p><svg class=Bob's></svg><p>{PROSE} End.</p></article>"
    assert html.extract(page).split("\n") == [PROSE, f"{PROSE} Two.", f"{PROSE} It's.", f"{PROSE} End."]
    # Names inside a value are no attributes.
    assert html.extract(f'<div title="class=comments hidden id=sidebar"><p>{PROSE}</p></div>') == PROSE


def test_code_and_names_between_good_paragraphs():
    code, names = "for (i = 0; i < n; i++) { total[i] = alpha[i] * beta[i]; print(total[i]); } // " * 2, "Anna Meier, Bert Klose, Carla Ruiz, Dora Lind, " * 3
    page = f"<p>{PROSE}</p><pre>{entities.escape(code)}</pre><p>{names}</p><p>{PROSE}</p><p>{names}</p><p><a href=a>menu link one</a></p>"
    assert html.extract(page).split("\n") == [PROSE, " ".join(code.split()), names.strip(), PROSE]


def test_teaser_card_beside_an_unmarked_body():
    body = "".join(f"<p>{PROSE}</p>" for _ in range(3))
    card = f"<article><h3><a href=x>Another story of the day</a></h3><p>{PROSE} Teaser.</p></article>"
    assert html.extract(f"<div>{body}</div>{card}").startswith("\n".join([PROSE] * 3))


def test_inherit_equals_brute_force():
    import random
    rng = random.Random(6)
    for _ in range(300):
        marked = rng.random() < 0.5
        found = [html.Block("t", 0, rng.random() < 0.2, rng.random() < 0.2, 0 if not marked else rng.randrange(1, 3), low=not marked and rng.random() < 0.2)
                 for _ in range(rng.randrange(1, 12))]
        for b in found:
            b.label = "bad" if b.away else rng.choice(["good", "bad", "undecided", "undecided"])
            b.low = b.low and b.label == "undecided"
        labels, want = [b.label for b in found], []
        for i, b in enumerate(found):
            if labels[i] != "undecided":
                want.append(labels[i])
                continue
            sides = []
            for order in (range(i - 1, -1, -1), range(i + 1, len(found))):
                side = None
                for j in order:
                    if found[j].away:
                        continue
                    if found[j].content != b.content:
                        break
                    if labels[j] != "undecided":
                        side = labels[j]
                        break
                sides.append(side)
            if b.low:
                want.append("good" if sides == ["good", "good"] else "bad")
            elif sides == [None, None]:
                want.append("good")
            elif None in sides or sides[0] == sides[1]:
                known = next(x for x in sides if x)
                want.append("good" if marked and None in sides else known)
            else:
                want.append("good" if marked or b.heading else "bad")
        html.inherit(found, marked)
        assert [b.label for b in found] == want
