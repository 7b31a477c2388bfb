"""The page walk on random trees, against a direct evaluation on the tree."""

import html

from hypothesis import given, settings
from hypothesis import strategies as st

from gleanframe.functions.html import Field, PageWalk, Step

CLASSES = ["a", "b", "ab"]
text = st.text(alphabet="xy &<>\"'\n", min_size=1, max_size=4)
node = st.recursive(
    text,
    lambda inner: st.tuples(st.sampled_from(["div", "span", "section"]),
                            st.lists(st.sampled_from(CLASSES), max_size=2),
                            st.lists(inner, max_size=4)),
    max_leaves=25)
step = st.builds(Step, st.sampled_from(["div", "span", None]), st.sampled_from(["a", "b", None]),
                 st.sampled_from(["a", None]), st.sampled_from([1, 2, None]))


def merged(children):
    """Neighbouring texts are one text node."""
    out = []
    for child in children:
        if isinstance(child, str) and out and isinstance(out[-1], str):
            out[-1] += child
        else:
            out.append(child)
    return out


def written(child):
    if isinstance(child, str):
        return html.escape(child)
    tag, classes, children = child
    attributes = f' title="a>b" class="{" ".join(classes)}"' if classes else ""
    return f"<{tag}{attributes}>{''.join(map(written, children))}</{tag}>"


def fits(test, element, place):
    tag, classes, _ = element
    joined = " ".join(classes)
    return ((test.tag is None or test.tag == tag) and (test.cls is None or test.cls in classes)
            and (test.cls_part is None or test.cls_part in joined) and test.nth in (None, place))


def expected(children, chain, path=()):
    """Direct texts of the elements whose ancestors hold the chain in order."""
    out, place = [], 0
    for child in merged(children):
        if isinstance(child, str):
            if path and reached(path, chain):
                out.append(child)
        else:
            place += 1
            out += expected(child[2], chain, (*path, (child, place)))
    return out


def reached(path, chain):
    if not fits(chain[-1], *path[-1]):
        return False
    at = 0
    for element, place in path[:-1]:
        if at < len(chain) - 1 and fits(chain[at], element, place):
            at += 1
    return at == len(chain) - 1


@settings(max_examples=400, deadline=None)
@given(st.lists(node, max_size=5), st.lists(step, min_size=1, max_size=3))
def test_walk_equals_tree(tree, chain):
    chain = tuple(chain)
    page = "".join(map(written, tree))
    assert PageWalk([Field("x", "texts", (chain,))])(page)["x"] == expected(tree, chain)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/abdivsp \"'=!-&;", max_size=80))
def test_any_text_is_walked_to_its_end(page):
    walk = PageWalk([Field("x", "texts", ((Step("div"),), (Step(None, "a"),)))])
    assert isinstance(walk(page)["x"], list)
