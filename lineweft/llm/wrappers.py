"""HTML extraction by wrappers: union-free regular expressions inferred from pages of one host.

A page is a stream of tags and texts, nested as its tags say. Reading a list of children,
neighbouring equal runs fold into a repeated group. Two pages of a host are aligned child
list by child list: what matches is merged, what only one side has becomes optional, texts
that differ become slots. Merging all pages of a layout gives its wrapper, an expression of
nested sequences with ``?`` and ``+`` and no unions, that every one of its pages matches.

A layout of a host are its pages with the same main element: article or main, or without one
the element that gathers most text outside links. The wrapper decides which slots hold the
main text: those under that element; slots under menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments never do, nor do blocks that are mostly
links where there is no article or main. Which texts all pages with a place share is kept with
the wrapper as ``template``; headings of an article often are such texts, so they stay in the
pages' texts, and a page reads alike however many others there are. Pages are then read by their layout's wrapper, slot by slot
as paths of labels; a page that has none of the slots is read by its own.

Elements nested deeper than ``_DEEPEST`` levels stand beside one another under the last level, in page
order, so no page is too deep; those inside a menu or the like stay part of it.

Tasks merge the pages of a layout they see, salted groups merge those, and one group per layout
merges the few wrappers left, so a host with a third of all pages costs a row per task.
Wrappers meet pages in a join that Spark plans by size.

Null pages and pages without main text give an empty text; pages with a null or odd url share a
host. Rows are read one by one: repeated rows and null ids stay as they are.
"""

from __future__ import annotations

import html as references
import json
import re
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|title|textarea|noscript|iframe|svg|template)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|</?[a-zA-Z][^>]*>|<![^>]*>|<\?[^>]*>|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>", re.DOTALL)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr b bdi bdo br cite code del dfn em font i img ins kbd mark q s samp small span strong sub sup time tt u var wbr".split()
)
_CLOSED_BY_NEXT = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()
)
_OTHER_TAGS = frozenset("head nav header footer aside form button select input dialog menu".split())
#: Names that tell what an element is not: alone, or with words that only say where or what kind of box it is.
_OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header menu nav navbar navigation newsletter notice pagination popup promo related share sharing sidebar "
    "social sponsor sponsored subscribe toolbar widget".split()
)
_BOX_NAMES = frozenset(
    "area articles bar block bottom box button buttons column container content form global icons inner item items left link links list "
    "main outer page panel posts primary right secondary section signup site slot top unit wrap wrapper".split()
)
_MAIN = ("article", "main")
#: Levels of nesting that are told apart; the functions below call themselves for each.
_DEEPEST = 150
_LONGEST_GROUP = 4
#: Pages that have to agree in a text before it is called template.
_TEMPLATE_PAGES = 5


@dataclass
class Node:
    """An element of a page or wrapper; ``#`` is a text slot, a label in brackets a repeated group.

    ``fixed`` are the hashes of the texts that all pages have here, with how many pages that are.
    """

    label: str
    optional: bool = False
    repeated: bool = False
    chars: int = 0
    pages: int = 1
    children: list[Node] = field(default_factory=list)
    text: str = ""
    fixed: dict[int, int] = field(default_factory=dict)

    def packed(self) -> list:
        children = [c.packed() for c in self.children]
        return [self.label, self.optional, self.repeated, self.chars, self.pages, children, list(self.fixed.items())]

    @classmethod
    def unpacked(cls, values: list) -> Node:
        label, optional, repeated, chars, pages, children, fixed = values
        return cls(label, optional, repeated, chars, pages, [cls.unpacked(c) for c in children], fixed=dict(fixed))

    def expression(self) -> str:
        """The wrapper as a regular expression over tags."""
        inner = " ".join(c.expression() for c in self.children)
        name = f"({inner})" if self.label.startswith("(") else f"{self.label}({inner})" if inner else self.label
        return name + "+" * self.repeated + "?" * self.optional


def _label(name: str, attributes: str) -> str:
    names = sorted({n.lower() for m in _NAMES.findall(attributes) for n in "".join(m).split()})
    return ".".join([name, *(n for n in names if not any(c.isdigit() for c in n))])


def page_tree(page: str) -> Node:
    """The page as nested elements and texts; unclosed elements end where their parent or the next of their kind does."""
    root = Node("")
    stack = [(root, "")]
    for match in _TOKEN.finditer(page):
        token = match[0]
        if token[0] != "<" or token == "<":
            stack[-1][0].children.append(Node("#", chars=len(token.strip()), text=token))
            continue
        tag = _TAG.match(token)
        if not tag:
            continue
        closing, name, attributes = tag[1], tag[2].lower(), tag[3]
        if match[1]:
            stack[-1][0].children.append(Node(name))
            continue
        if closing:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][1] == name), 0)
            if at:
                del stack[at:]
            continue
        ends = _CLOSED_BY_NEXT.get(name, {"p"} if name in _ENDS_PARAGRAPH else None)
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][1] in ends:
                    del stack[i:]
                    break
                if stack[i][1] not in _INLINE:
                    break
        node = Node(_label(name, attributes))
        parent = stack[-1][0]
        if len(stack) > _DEEPEST:
            # What a menu or the like holds stays part of it.
            node.label = parent.label if len(stack) > _DEEPEST + 1 and _is_other(parent.label) else node.label
            parent = stack[_DEEPEST - 1][0]
        parent.children.append(node)
        if name not in _VOID and not attributes.rstrip().endswith("/"):
            stack.append((node, name))
    return root


def fold(children: list[Node]) -> list[Node]:
    """Neighbouring equal runs as one repeated element or group."""
    out: list[Node] = []
    for child in children:
        out.append(child)
        shrunk = True
        while shrunk:
            shrunk = False
            for width in range(1, min(_LONGEST_GROUP, len(out) - 1) + 1):
                last, before = out[-width:], out[-width - 1]
                if before.label.startswith("(") and [c.label for c in before.children] == [c.label for c in last]:
                    before.children = [merge(a, b) for a, b in zip(before.children, last, strict=True)]
                elif len(out) >= 2 * width and [c.label for c in out[-2 * width : -width]] == [c.label for c in last]:
                    both = [merge(a, b) for a, b in zip(out[-2 * width : -width], last, strict=True)]
                    if width == 1:
                        both[0].repeated = True
                        out[-2:] = both
                    else:
                        group = Node("(" + " ".join(c.label for c in both) + ")", repeated=True, children=both)
                        out[-2 * width :] = [group]
                    shrunk = True
                    break
                else:
                    continue
                del out[-width:]
                shrunk = True
                break
    return out


def merge(a: Node, b: Node, across: bool = False) -> Node:
    """The expression that both match; labels are equal. ``across``: they are of different pages, so only common texts stay fixed."""
    if across:
        fixed = {text: pages + b.fixed[text] for text, pages in a.fixed.items() if text in b.fixed}
    else:
        fixed = {text: max(a.fixed.get(text, 0), b.fixed.get(text, 0)) for text in {**a.fixed, **b.fixed}}
    return Node(
        a.label,
        a.optional or b.optional,
        a.repeated or b.repeated,
        a.chars + b.chars,
        max(a.pages, b.pages),
        align(a.children, b.children, across),
        fixed=fixed,
    )


def align(one: list[Node], two: list[Node], across: bool = False) -> list[Node]:
    labels = [[c.label for c in x] for x in (one, two)]
    if labels[0] == labels[1]:
        return [merge(a, b, across) for a, b in zip(one, two, strict=True)]
    out: list[Node] = []
    for kind, a, a_end, b, b_end in SequenceMatcher(None, *labels, autojunk=False).get_opcodes():
        if kind == "equal":
            out += [merge(x, y, across) for x, y in zip(one[a:a_end], two[b:b_end], strict=True)]
            continue
        for child in [*one[a:a_end], *two[b:b_end]]:
            child.optional = True
            out.append(child)
    return fold(out)


def page_wrapper(node: Node) -> Node:
    """A page as an expression: children folded from the inside out, texts as their hashes."""
    fixed = {text_hash(node.text): 1} if node.chars else {}
    return Node(node.label, chars=node.chars, children=fold([page_wrapper(c) for c in node.children]), fixed=fixed)


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(text.split()))


def merged(one: Node, two: Node) -> Node:
    both = merge(one, two, across=True)
    both.pages = one.pages + two.pages
    return both


def _is_other(label: str) -> bool:
    name, *names = label.split(".")
    return name in _OTHER_TAGS or any(_says_other(re.split("[-_]", n)) for n in names)


def _says_other(words: list[str]) -> bool:
    """``social-links`` or ``top_menu``, but not ``share-price``."""
    return any(w in _OTHER_NAMES for w in words) and all(w in _OTHER_NAMES or w in _BOX_NAMES or not w for w in words)


def _slots(root: Node) -> tuple[dict[str, list], set[str]]:
    """Characters outside and inside links by path of text and by its block's; paths of the outermost main elements with text."""
    found: dict[str, list] = {}
    mains: set[str] = set()

    def visit(node: Node, path: str, block: str, main: str | None, link: bool):
        for child in node.children:
            if child.label.startswith("("):
                visit(child, path, block, main, link)
            elif child.label == "#":
                found.setdefault(path, [main is not None, block, 0, 0])[3 if link else 2] += child.chars
                if main is not None and child.chars:
                    mains.add(main)
            else:
                name = child.label.split(".")[0]
                below = f"{path}/{child.label}"
                here = below if main is None and name in _MAIN else main
                if _is_read(child.label, here is not None):
                    visit(child, below, block if name in _INLINE else below, here, link or name == "a")

    visit(root, "", "", None, False)
    return found, mains


def _is_read(label: str, inside: bool) -> bool:
    return not _is_other(label) or (inside and label == "header")


def _main(root: Node) -> tuple[str, list[str]]:
    """Layout, that is the main element, of a page or wrapper, and the paths of the elements whose own texts are main text."""
    found, mains = _slots(root)
    if mains:
        return " ".join(sorted(mains)), sorted(path for path, (inside, *_) in found.items() if inside)
    blocks: dict[str, list] = {}
    for _, block, plain, linked in found.values():
        both = blocks.setdefault(block, [0, 0])
        both[0] += plain
        both[1] += linked
    texts = {path: plain + linked for path, (_, block, plain, linked) in found.items() if blocks[block][0] > blocks[block][1]}
    total = sum(texts.values())
    base = ""
    while True:
        # Go down while one child element gathers most of the text.
        below: dict[str, int] = {}
        for path, chars in texts.items():
            if path.startswith(base + "/"):
                step = path[len(base) + 1 :].split("/")[0]
                below[step] = below.get(step, 0) + chars
        best = max(below, key=below.get, default=None)
        if best is None or below[best] < 0.6 * total or best.split(".")[0] in ("p", *_INLINE):
            break
        base = f"{base}/{best}"
    return base, sorted(path for path in texts if path == base or path.startswith(base + "/"))


def main_paths(wrapper: Node) -> list[str]:
    """Paths of the elements whose own texts are main text."""
    return _main(wrapper)[1]


def template_texts(wrapper: Node) -> list[str]:
    """Hash and path of the main texts that all pages with the place have."""
    chosen, out = set(main_paths(wrapper)), set()

    def visit(node: Node, path: str):
        for child in node.children:
            if child.label == "#" and path in chosen:
                enough = (t for t, n in child.fixed.items() if n >= _TEMPLATE_PAGES and 2 * n >= wrapper.pages)
                out.update(f"{text} {path}" for text in enough)
            visit(child, path if child.label.startswith(("(", "#")) else f"{path}/{child.label}")

    visit(wrapper, "")
    return sorted(out)


def page_texts(page: Node) -> list[tuple[str, int, str]]:
    """Path, number of the block and text of every text that may be main text."""
    out: list[tuple[str, int, str]] = []
    block = 0

    def visit(node: Node, path: str, inside: bool):
        nonlocal block
        for child in node.children:
            if child.label == "#":
                out.append((path, block, child.text))
                continue
            name = child.label.split(".")[0]
            here = inside or name in _MAIN
            if name not in _INLINE:
                block += 1
            elif name == "br":
                out.append((path, block, " "))
            if _is_read(child.label, here):
                visit(child, f"{path}/{child.label}", here)
            if name not in _INLINE:
                block += 1

    visit(page, "", False)
    return out


def main_text(texts: list[tuple[str, int, str]], paths: frozenset[str]) -> str:
    """Texts of the slots, one block a line."""
    blocks: dict[int, list[str]] = {}
    for path, block, text in texts:
        if path in paths:
            blocks.setdefault(block, []).append(references.unescape(text))
    lines = (" ".join("".join(block).split()) for block in blocks.values())
    return "\n".join(line for line in lines if line)


def _wrapper_rows(layouts: dict[tuple[str, str], Node], salt: int) -> pa.RecordBatch:
    packed = [json.dumps(node.packed()) for node in layouts.values()]
    hosts, mains = ([key[i] for key in layouts] for i in (0, 1))
    return pa.RecordBatch.from_pydict(
        {"host": pa.array(hosts, pa.string()), "layout": pa.array(mains, pa.string()),
         "salt": pa.array([salt] * len(layouts), pa.int32()), "wrapper": pa.array(packed, pa.string())}
    )


def infer_wrappers(pages: DataFrame, html: str = "html", url: str = "url", salts: int = 16) -> DataFrame:
    """(host, layout, wrapper, expression, paths, template) of every layout of a host, merged over all its pages."""
    schema = "host string, layout string, salt int, wrapper string"

    def of_task(batches):
        layouts: dict[tuple[str, str], Node] = {}
        salt = TaskContext.get().partitionId() % salts
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                tree = page_tree(page or "")
                key, wrapper = (host, _main(tree)[0]), page_wrapper(tree)
                layouts[key] = merged(layouts[key], wrapper) if key in layouts else wrapper
                if len(layouts) > 10_000:
                    yield _wrapper_rows(layouts, salt)
                    layouts.clear()
        yield _wrapper_rows(layouts, salt)

    def of_group(key, table):
        values = [Node.unpacked(json.loads(w)) for w in table.column("wrapper").to_pylist()]
        whole = values[0]
        for value in values[1:]:
            whole = merged(whole, value)
        return pa.Table.from_batches([_wrapper_rows({(key[0].as_py(), key[1].as_py()): whole}, 0)])

    def finished(batches):
        for batch in batches:
            nodes = [Node.unpacked(json.loads(w)) for w in batch.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {"host": batch.column("host"), "layout": batch.column("layout"), "wrapper": batch.column("wrapper"),
                 "expression": pa.array([n.expression() for n in nodes], pa.string()),
                 "paths": pa.array([main_paths(n) for n in nodes], pa.list_(pa.string())),
                 "template": pa.array([template_texts(n) for n in nodes], pa.list_(pa.string()))}
            )

    rows = pages.select(_host(url).alias("host"), F.col(html).alias("html")).mapInArrow(of_task, schema)
    by_salt = rows.groupBy("host", "layout", "salt").applyInArrow(of_group, schema)
    by_layout = by_salt.groupBy("host", "layout").applyInArrow(of_group, schema)
    return by_layout.mapInArrow(
        finished, "host string, layout string, wrapper string, expression string, paths array<string>, template array<string>"
    )


def _host(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z]+://([^/?#]*)", 1)), F.lit(""))


_TEXTS = pa.list_(pa.struct([("path", pa.int32()), ("block", pa.int32()), ("text", pa.string())]))


def extract(pages: DataFrame, wrappers: DataFrame, html: str = "html", url: str = "url", id: str = "page_id") -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every page, read by its layout's wrapper."""
    rows = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), _host(url).alias("host"))
    id_type = rows.schema["page_id"].dataType.simpleString()

    def split(batches):
        """A page's texts with numbers for paths, the paths, its layout and the paths it would be read by alone."""
        for batch in batches:
            layouts, named, own, found = [], [], [], []
            for page in batch.column("html").to_pylist():
                tree = page_tree(page or "")
                layout, alone = _main(tree)
                texts = page_texts(tree)
                numbers = {path: at for at, path in enumerate(dict.fromkeys(path for path, *_ in texts))}
                layouts.append(layout)
                named.append(list(numbers))
                own.append([numbers[path] for path in alone])
                found.append([(numbers[path], block, text) for path, block, text in texts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(layouts, pa.string()),
                 pa.array(named, pa.list_(pa.string())), pa.array(own, pa.list_(pa.int32())), pa.array(found, _TEXTS)],
                ["page_id", "url", "host", "layout", "named", "own", "texts"],
            )

    def read(batches):
        for batch in batches:
            known: dict[tuple, frozenset] = {}
            out = []
            columns = (batch.column(c).to_pylist() for c in ("named", "own", "texts", "paths"))
            for named, own, texts, paths in zip(*columns, strict=True):
                key = tuple(paths or ())
                placed = [(named[x["path"]], x["block"], x["text"]) for x in texts]
                text = main_text(placed, known.setdefault(key, frozenset(key)))
                out.append(text or main_text(placed, frozenset(named[at] for at in own)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"]
            )

    parted = rows.mapInArrow(
        split,
        f"page_id {id_type}, url string, host string, layout string, named array<string>, own array<int>, "
        "texts array<struct<path:int,block:int,text:string>>",
    )
    joined = parted.join(wrappers.select("host", "layout", "paths"), ["host", "layout"], "left").select(
        "page_id", "url", "named", "own", "texts", "paths"
    )
    return joined.mapInArrow(read, f"page_id {id_type}, url string, text string")
