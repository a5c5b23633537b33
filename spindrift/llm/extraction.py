"""Main text of web pages by wrappers: union-free regular expressions inferred from pages of the same host.

Every page is read once, as a whole stream of tags and block texts. A block's start with the text that follows it is
one token, whatever links and the like the text holds; adjacent equal stretches of a stream fold into repeated groups. The distinct structures of all pages of a host are aligned one after another, in groups of ``FAN`` over
tasks and the groups' expressions in turn: tokens that only one side has become optional (those that fewer pages have
than a template needs are left out, so an expression does not grow with the pages). Each page is then matched with its host's expression, and the texts at each
place are counted over all pages: a text in which at least ``SUPPORT`` different pages, ``SHARE`` of the host's and
``AGREE`` of those with the place agree is the template's (within the main region only before the page's first own text
and after its last), other texts are slots. The main region is the container that holds most text of slots and groups
of all pages, outside of navigation, notices, forms and the like. A page's text is what meets slots, groups or nothing
within the region, in blocks, without such parts and the template's texts. Where a page lacks its wrapper's region, the
region is found in the page alone.

Defined cases: a null or empty html gives the empty text; a null or odd url counts as host ''; pages of an unseen
structure are read alone; repeated rows repeat; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import functools
import hashlib
import html as entities
import json
import math
import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import cut

#: The longest stretch that is looked for as a group, the pages (and the share of a host's pages) that must agree in a
#: text to make it the template's, the share of a place's pages that must, expressions merged at a time, and bits of an
#: alignment's table held at a time.
GROUP, SUPPORT, SHARE, AGREE, FAN, TABLE = 10, 3, 0.5, 0.9, 64, 100_000_000
#: Bytes of wrappers (one a host) up to which all tasks get them all, and tasks a host's pages go to beyond that.
SENT, SALT = 48_000_000, 32
SCHEMA = "page_id long, url string, text string, n_chars long, wrapped boolean"
STREAMS = "page_id long, url string, host string, digest binary, keys array<long>, texts array<long>, body binary"

# The names of HTML elements by their role (fixed values).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
INLINE = set("b i em strong a span br u font small sup sub img code".split())
ASIDE = set("nav header footer aside form head menu dialog button select textarea noscript template iframe svg object canvas audio video datalist".split())
RAW = "script|style|title|textarea|noscript|iframe|template|xmp"
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ASIDE_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
#: Words that, as a whole class or id, mark what is not the article; of these, words that do so at either end of a
#: compound ("post-comments"), where the others do only if the part holds no running text; and openings of a compound
#: that speak of a state ("has-sidebar") or of the article ("article-header") (fixed values).
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification alert nav navbar navigation navi menu"
    " breadcrumb breadcrumbs sidebar sidenav aside rail footer header masthead topbar toolbar comment comments commentlist reply replies respond disqus discussion share sharing social related recommended"
    " newsletter subscribe subscription signup login popup modal overlay widget pagination pager search toc skip paywall".split()
)
ASIDE_ENDS = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsored promo cookie cookies consent gdpr nav navbar menu breadcrumb breadcrumbs footer comment comments commentlist replies respond disqus newsletter subscribe"
    " signup login popup modal overlay pagination pager paywall".split()
)
STATES = set("has with without no not is".split())
OF_ARTICLE = set("article post entry content story text".split())
#: Characters of a paragraph that make a part running text, and the most of its text that may be links.
RUNNING, LINKED = 60, 0.5
#: Of the text, what a container must hold to be the region.
HELD = 0.6

TOKEN = re.compile(rf"<!--.*?(?:-->|$)|<[!?][^>]*>?|<({RAW})\b[^>]*>.*?(?:</\1\s*>|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"<]*\"|'[^'<]*')*+(?=>)|[^>]*)>?|[^<]+|<", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")


def named_aside(names: list[str]) -> bool | str:
    """What classes and ids say of a part: it stands aside ("part"), it does unless it holds running text ("perhaps"), or
    they say nothing (False)."""
    found: bool | str = False
    for name in names:
        words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
        if len(words) == 1 and words[0] in ASIDE_WORDS or len(words) > 1 and words[0] not in STATES and (words[0] in ASIDE_ENDS or words[-1] in ASIDE_ENDS):
            return "part"
        if len(words) > 1 and words[0] not in STATES and (words[0] in ASIDE_WORDS or words[-1] in ASIDE_WORDS) and not (words[0] in OF_ARTICLE and words[-1] == "header"):
            found = "perhaps"
    return found


def decided(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """The page's tokens, where each part that its names put aside is looked into first: a part that holds an article or
    main element never stands aside by name, and one that only perhaps does must not hold running text."""
    found = list(tokens(page))
    open_: list[int] = []  # places of starts
    named: dict[int, list] = {}  # of open parts put aside by name: [characters, of these in links, longest paragraph]
    verdict: dict[int, bool] = {}
    links = paragraph = 0

    def end(i: int) -> None:
        chars, linked, longest = named.pop(i)
        verdict.setdefault(i, found[i][3] == "part" or not (longest >= RUNNING and linked < LINKED * chars))

    for n, (kind, name, what, aside) in enumerate(found):
        if kind == "<" and name not in VOID:
            open_.append(n)
            links += name == "a"
            paragraph = 0 if name in BLOCKS else paragraph
            if isinstance(aside, str):
                named[n] = [0, 0, 0]
            if name in ("article", "main"):
                verdict |= dict.fromkeys(named, False)
        elif kind == ">":
            paragraph = 0 if name in BLOCKS else paragraph
            k = len(open_) - 1
            while k >= 0 and found[open_[k]][1] != name:
                k -= 1
            for i in open_[k:][::-1] if k >= 0 else ():
                links -= found[i][1] == "a"
                if i in named:
                    end(i)
            del open_[k if k >= 0 else len(open_) :]
        elif kind == "#" and named:
            size = len(what.strip())
            paragraph += 0 if links else size
            for counts in named.values():
                counts[0] += size
                counts[1] += size if links else 0
                counts[2] = max(counts[2], paragraph)
    for i in list(named):
        end(i)
    for n, (kind, name, what, aside) in enumerate(found):
        yield kind, name, what, verdict[n] if isinstance(aside, str) else aside


def tokens(page: str) -> Iterator[tuple[str, str, str, bool | str]]:
    """(kind, name, key or text, aside) with kind < for start, > for end, # for text. Comments, declarations and raw
    elements are dropped; a key is the name with id and classes."""
    for m in TOKEN.finditer(page):
        if m[3]:
            name = m[3].lower()
            if m[2]:
                yield ">", name, name, False
                continue
            attributes = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(m[4])} if m[4].strip() else {}
            words = re.split(r"[^a-z0-9]+", f"{attributes.get('id', '')} {attributes.get('class', '')}")
            hidden = attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")) or re.search(r"\bhidden\b", re.sub(ATTRIBUTE, " ", m[4]))
            aside: bool | str = name in ASIDE or attributes.get("role") in ASIDE_ROLES or bool(hidden)
            if not aside and name not in ("html", "body", "article", "main") and not ASIDE_WORDS.isdisjoint(words):
                aside = named_aside(f"{attributes.get('id', '')} {attributes.get('class', '')}".split())
            yield "<", name, ".".join([name, *sorted({w for w in words if w and not w.isdigit()})]), aside
        elif m[0][0] != "<" or m[0] == "<":
            yield "#", "", m[0], False


class Paths:
    """The paths of open elements' keys, each known by a number: its parent's number and its last key."""

    def __init__(self):
        self.known: dict[tuple[int, str], int] = {}
        self.parent, self.key, self.depth = [-1], [""], [0]

    def under(self, parent: int, key: str) -> int:
        found = self.known.setdefault((parent, key), len(self.parent))
        if found == len(self.parent):
            self.parent.append(parent)
            self.key.append(key)
            self.depth.append(self.depth[parent] + 1)
        return found

    def keys(self, path: int) -> list[str]:
        out = []
        while path > 0:
            out.append(self.key[path])
            path = self.parent[path]
        return out[::-1]

    def within(self, region: list[str]) -> list[bool]:
        """Of each path, whether it begins with the region's keys."""
        agree = [0] * len(self.parent)
        for p in range(1, len(agree)):
            up = self.parent[p]
            n = self.depth[up]
            agree[p] = agree[up] + (agree[up] == n < len(region) and region[n] == self.key[p])
        return [n == len(region) for n in agree]


def placed(page: str, paths: Paths) -> Iterator[tuple[str, str, str, int, bool]]:
    """(kind, name, key or text, path of open keys, in an aside part) with the elements' ends put right. An open element
    knows its path and whether it, or a part about it, stands aside (or is a heading part that an article ends)."""
    stack: list[tuple[str, int, bool, bool]] = []
    opened: Counter[str] = Counter()

    def close(i: int) -> None:
        for name, *_ in stack[i:]:
            opened[name] -= 1
        del stack[i:]

    top = (0, False, False)
    for kind, name, what, aside in decided(page):
        if kind == "<":
            if name in ("article", "main") and top[2]:  # an unclosed part ends where the article starts
                i = len(stack)
                while i and stack[i - 1][2]:
                    i -= 1
                close(i)
            closes = CLOSES.get(name, {"p"} if name in BLOCKS else ())
            if any(opened[c] for c in closes):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in closes:
                        close(i)
                        break
                    if stack[i][0] in BLOCKS and stack[i][0] != "p":
                        break
            if name == "body":
                bare = [s for s in stack if s[0] == "html"][:1]
                close(0)
                if bare:
                    stack.append(("html", paths.under(0, paths.key[bare[0][1]]), False, False))
                    opened["html"] += 1
            top = stack[-1][1:] if stack else (0, False, False)
            yield "<", name, what, top[0], top[1]
            if name not in VOID:
                top = (paths.under(top[0], what), top[1] or aside, top[2] or aside and name in ("nav", "header", "head"))
                stack.append((name, *top))
                opened[name] += 1
        elif kind == ">":
            if opened[name]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        close(i)
                        break
            top = stack[-1][1:] if stack else (0, False, False)
            yield ">", name, what, top[0], top[1]
        else:
            yield "#", "", what, top[0], top[1]


def running(digest: str, items: list[tuple]) -> str:
    """The digest of the texts so far, and of these items' texts."""
    for item in items:
        digest = hashlib.blake2b(f"{digest}\x1f{item[2] or ''}".encode(), digest_size=8).hexdigest()
    return digest


def fold(stream: list[tuple]) -> tuple[list[tuple], list[int]]:
    """Adjacent equal stretches of up to GROUP items become one repeated group ("+", items, digest of all its texts); and
    where each result begins in the stream."""
    out: list[tuple] = []
    keys: list[tuple] = []
    starts: list[int] = []
    for n, item in enumerate(stream):
        out.append(item)
        keys.append(item[:2])
        starts.append(n)
        size = 1
        while size <= GROUP and size < len(out):
            before = keys[-size - 1]
            if before[0] == "+" and before[1] == tuple(keys[-size:]):
                out[-size - 1] = (*out[-size - 1][:2], running(out[-size - 1][2], out[-size:]), *out[-size - 1][3:])
                del out[-size:], keys[-size:], starts[-size:]  # one more of the group before
                break
            if before == keys[-1] and keys[-size:] == keys[-2 * size : -size]:
                group = ("+", tuple(keys[-size:]), running("", out[-2 * size :]), out[-size][3], False)
                del out[-2 * size :], keys[-2 * size :], starts[1 - 2 * size :]
                out.append(group)
                keys.append(group[:2])
                size = 0  # the group may repeat in turn
            size += 1
    return out, starts


def folded(stream: list[tuple]) -> list[tuple]:
    return fold(stream)[0]


def leaves(found: list[tuple]) -> tuple[list[tuple], list[int]]:
    """A block's start with its text, and its end if that follows ("=", else ":"), become one token; and where each result
    begins."""
    out: list[tuple] = []
    starts: list[int] = []
    n = 0
    while n < len(found):
        kind, key = found[n][:2]
        starts.append(n)
        end = n + 1
        if kind == "<" and (name := key.split(".")[0]) in BLOCKS:
            while end < len(found) and found[end][0] != "#" and found[end][1].split(".")[0] not in BLOCKS:
                end += 1
            if end < len(found) and found[end][0] == "#":
                closed = found[end + 1 : end + 2] and found[end + 1][:2] == (">", name)
                out.append(("=" if closed else ":", key, found[end][2], found[end][3], False))
                n = end + 2 if closed else end + 1
                continue
        out.append(found[n])
        n += 1
    return out, starts


def stream(found: list[tuple]) -> tuple[list[tuple], list[int]]:
    """The folded stream of a page's tokens, and where each of its items begins in the page's."""
    items, places = leaves(found)
    out, starts = fold(items)
    return out, [places[n] for n in starts]


def common(a: list, b: list) -> list[tuple[int, int]]:
    """Places (i, j) of a longest common subsequence. Rows of the table are bits of one integer (Hyyro 2004); a table of
    more than TABLE bits is halved first (Hirschberg 1975), so memory is bounded and nothing is left out."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    ends = [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]
    pairs = [(k, k) for k in range(head)]
    if len(x) > 1 and len(x) * len(y) > TABLE:
        half = len(x) // 2
        left, right = gains(rows_of(x[:half], y)[-1], len(y)), gains(rows_of(x[half:][::-1], y[::-1])[-1], len(y))
        cut = int(np.argmax(left + right[::-1]))
        pairs += [(head + i, head + j) for i, j in common(x[:half], y[:cut])]
        return pairs + [(head + half + i, head + cut + j) for i, j in common(x[half:], y[cut:])] + ends
    rows = rows_of(x, y, True)
    i, j, inner = len(x), len(y), []
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if rows[i] >> (j - 1) & 1:
                j -= 1
                inner.append((head + i, head + j))
    return pairs + inner[::-1] + ends


def rows_of(a: list, b: list, every: bool = False) -> list[int]:
    """The last or every row of the table: bit j is 0 where the longest common subsequence grows with b[j]."""
    at: dict = {}
    for j, y in enumerate(b):
        at.setdefault(y, []).append(j)
    masks = {}
    for x in {x for x in a if x in at}:
        bits = bytearray(len(b) // 8 + 1)
        for j in at[x]:
            bits[j >> 3] |= 1 << (j & 7)
        masks[x] = int.from_bytes(bits, "little")
    full = (1 << len(b)) - 1
    row, rows = full, [full]
    for x in a:
        if mask := masks.get(x, 0):
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
        if every:
            rows.append(row)
    return rows if every else [row]


def gains(row: int, n: int) -> np.ndarray:
    """Length of the longest common subsequence with each prefix of 0 to n items."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def union(a: list, b: list) -> list:
    """One expression for both: common tokens once, others in the order of both."""
    out: list = []
    i = j = 0
    for m, n in [*common(a, b), (len(a), len(b))]:
        out += [*a[i:m], *b[j:n], *a[m : m + 1]]
        i, j = m + 1, n + 1
    return out


def unions(structures: Iterable[tuple]) -> list:
    """One expression for all of them, whatever their order."""
    first, *others = sorted(structures, key=lambda x: (len(x), x))
    return functools.reduce(union, others, list(first))


def least(n: int) -> int:
    """Of n pages, those that must agree to make a template."""
    return max(SUPPORT, math.ceil(SHARE * n))


def parsed(page: str, paths: Paths) -> tuple[list[tuple], list[int]]:
    """The page's whole stream of (kind, key, text or None, path, False, parts), and the paths of blank texts. The text
    of a block is one item; its parts are the raw texts outside aside parts, with their paths."""
    found: list[tuple] = []
    blank: list[int] = []
    parts: list[tuple[str, int]] = []
    beside: list[str] = []

    def close(path: int) -> None:
        text = " ".join("".join(p for p, _ in parts).split())
        if text:
            found.append(("#", "", text, path, False, tuple(parts)))
        elif other := " ".join("".join(beside).split()):
            found.append(("#", "", other, path, False, ()))
        parts.clear()
        beside.clear()

    for kind, name, what, path, aside in placed(page, paths):
        if kind == "#":
            if aside:
                beside.append(what)
            else:
                if what.isspace():
                    blank.append(path)
                parts.append((entities.unescape(what), path))
        elif name in BLOCKS:
            close(path)
            found.append((kind, what, None, path, False, ()))
        elif name == "br":
            parts.append((" ", path))
        elif name not in INLINE:
            found.append((kind, what, None, path, False, ()))
    close(0)
    return found, blank


@functools.lru_cache(100_000)
def key_of(kind: str, key: object) -> int:
    return int.from_bytes(hashlib.blake2b(repr((kind, key)).encode(), digest_size=6).digest(), "little")


def digest_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=7).digest(), "little")


@functools.lru_cache(100_000)
def path_id(parent: int, key: str) -> int:
    return digest_of(f"{parent}\x1f{key}")


def ids_of(paths: Paths) -> list[int]:
    """A number of each path that is the same in all pages (0: the root)."""
    ids = [0]
    for p in range(1, len(paths.parent)):
        ids.append(path_id(ids[paths.parent[p]], paths.key[p]))
    return ids


def role(key: str) -> int:
    """Whether an element is an article or main part (0), another container (1) or neither (2)."""
    name = key.split(".")[0]
    return 0 if name in ("article", "main") else 1 if name in ("body", "div", "section", "td", "html", "center", "blockquote") else 2


def masses(parts: list[tuple[str, int]], paths: Paths) -> tuple[list[int], list[bool]]:
    """Of each path, the characters of these texts under it, and whether any of them is there."""
    mass = [0] * len(paths.parent)
    there = [False] * len(paths.parent)
    for text, path in parts:
        mass[path] += len(text.strip())
        there[path] = True
    for p in range(len(mass) - 1, 0, -1):  # a path's number is above its parent's
        mass[paths.parent[p]] += mass[p]
        there[paths.parent[p]] |= there[p]
    return mass, there


def region_of(parts: list[tuple[str, int]], paths: Paths) -> list[str]:
    """The path of the container with most of these texts: an article or main part where there is one, else the deepest
    one that holds at least 60 %."""
    mass, there = masses(parts, paths)
    every = [p for p in range(1, len(mass)) if there[p]]
    if not every:
        return []
    if named := [p for p in every if role(paths.key[p]) == 0]:
        most = max((mass[p], -paths.depth[p]) for p in named)
        return max(paths.keys(p) for p in named if (mass[p], -paths.depth[p]) == most)
    whole = max(mass[p] for p in every)
    good = [p for p in every if mass[p] >= HELD * whole and role(paths.key[p]) == 1]
    most = max(((paths.depth[p], mass[p]) for p in good), default=None)
    return max(paths.keys(p) for p in good if (paths.depth[p], mass[p]) == most) if good else []


def infer(pages: list[str]) -> dict:
    """The wrapper of some pages in one process, as `wrappers` and `regions` find it over tasks: the expression, as text,
    its number of slots and its main region."""
    paths = Paths()
    found = [parsed(page, paths)[0] for page in pages]
    streams = [stream(x) for x in found]
    structures = [tuple(x[:2] for x in items) for items, _ in streams]
    pages_of = Counter(k for one in structures for k in set(one))
    wrapper = unions({tuple(key_of(*k) for k in one if pages_of[k] >= least(len(pages))) for one in structures})
    names = {key_of(*k): k for k in pages_of}
    seen: dict[int, Counter] = {}
    places = [dict(common(wrapper, [key_of(*k) for k in one])) for one in structures]
    for at, (items, _) in zip(places, streams, strict=True):
        for i, j in at.items():
            seen.setdefault(i, Counter())[items[j][2]] += 1
    top = {i: c.most_common(1)[0] for i, c in seen.items()}
    fixed = {i: text for i, (text, n) in top.items() if text is not None and n >= least(len(pages)) and n >= AGREE * seen[i].total()}
    show, slots = [], 0
    for i, (kind, key) in enumerate(names[k] for k in wrapper):
        slots += kind in "#=:" and i not in fixed
        one = shown(kind, key)
        if kind in "#=:":
            one = one.replace("#", "#" + json.dumps(fixed[i]) if i in fixed else "#slot")
        show.append(f"({one})?" if seen.get(i, Counter()).total() < len(pages) else one)
    free, every = [], []
    for at, (items, starts), all_ in zip(places, streams, found, strict=True):
        template = {j for i, j in at.items() if i in fixed and fixed[i] == items[j][2]}
        for j, (start, end) in enumerate(zip(starts, [*starts[1:], len(all_)], strict=True)):
            parts = [p for x in all_[start:end] for p in x[5]]
            every += parts
            free += [] if j in template else parts
    return {"expression": "".join(show), "slots": slots, "region": region_of(free, paths) or region_of(every, paths)}


def shown(kind: str, key: object) -> str:
    if kind == "+":
        return "({})+".format("".join(shown(*k) for k in key))
    name = key.split(".")[0]
    return {"#": "#", "<": f"<{key}>", ">": f"</{key}>", ":": f"<{key}>#", "=": f"<{key}>#</{name}>"}[kind]


def main_text(page: tuple[list[tuple], list[int]], paths: Paths, region: list[str], template: set[int] = frozenset()) -> tuple[str, bool]:
    """Text of the region's blocks without the template's texts before its first own block and after its last, and whether
    the page has the region: what stands between own texts, such as a heading that many articles share, is the
    article's. Where the region holds nothing else, it is the page's text (copies of one page agree in all of it)."""
    inside = paths.within(region)
    found, blank = page
    blocks: list[tuple[int, str]] = []
    for n, item in enumerate(found):
        if item[5]:
            text = " ".join("".join(p for p, path in item[5] if inside[path]).split())
            if text:
                blocks.append((n, text))
    own = [k for k, (n, _) in enumerate(blocks) if n not in template]
    kept = blocks[own[0] : own[-1] + 1] if own else blocks
    return "\n".join(text for _, text in kept), bool(blocks) or any(inside[path] for path in blank)


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page its folded stream, as keys and digests of texts (-1: none), and its body: the parts of each block text
    with the place in the folded stream, the paths of blank texts, and the paths."""
    for batch in batches:
        digests, keys, texts, bodies = [], [], [], []
        for page in batch.column(3).to_pylist():
            if not page:
                for column in (digests, keys, texts, bodies):
                    column.append(None)
                continue
            paths = Paths()
            found, blank = parsed(page, paths)
            items, starts = stream(found)
            at = np.repeat(np.arange(len(items)), np.diff([*starts, len(found)])).tolist()
            digests.append(hashlib.blake2b(page.encode("utf-8", "surrogatepass"), digest_size=16).digest())
            keys.append([key_of(*x[:2]) for x in items])
            texts.append([-1 if x[2] is None else digest_of(x[2]) for x in items])
            bodies.append(pickle.dumps(([(j, x[5]) for j, x in zip(at, found, strict=True) if x[5]], blank, paths.parent, paths.key), 5))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(3)), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(texts, pa.list_(pa.int64())), pa.array(bodies, pa.binary())],
            names=["page_id", "url", "host", "digest", "keys", "texts", "body"],
        )


def met(rows: DataFrame, known: DataFrame, *on: str) -> DataFrame:
    """Each page with what its host is known by (`wrapper`; null: nothing). Salted by the columns ``on``."""
    size = known.agg(F.coalesce(F.sum(F.octet_length("wrapper") + F.octet_length("host")), F.lit(0))).first()[0]
    if size <= SENT:
        return rows.join(F.broadcast(known), "host", "left")
    # the pages go to the wrappers, those of one host to several tasks
    salt = F.pmod(F.xxhash64(*on), F.lit(SALT)).cast("int")
    spread = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return rows.withColumn("salt", salt).join(spread, ["host", "salt"], "left").drop("salt")


def least_of(n: str) -> F.Column:
    return F.greatest(F.lit(SUPPORT), F.ceil(F.lit(SHARE) * F.col(n)))


def expressions(pages: DataFrame, sizes: DataFrame) -> DataFrame:
    """(host, keys): one expression for all pages (host, keys) of each host, merged in groups of FAN structures."""
    rows = cut(pages.groupBy("host", "keys").agg(F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()))
    often = rows.select("host", "n", F.explode(F.array_distinct("keys")).alias("key")).groupBy("host", "key").agg(F.sum("n").alias("n"))
    often = often.join(sizes, "host").where(F.col("n") >= least_of("pages")).select("host", "key")
    kept = rows.select("host", "id", F.posexplode("keys").alias("pos", "key")).join(often, ["host", "key"]).groupBy("host", "id")
    kept = kept.agg(F.sort_array(F.collect_list(F.struct("pos", "key")))["key"].alias("keys")).select("host", "keys").distinct()
    kept = cut(kept)
    many = kept.groupBy("host").agg(F.count("*").alias("n"))
    now = kept.join(many, "host").select("host", F.pmod(F.xxhash64("keys"), F.ceil(F.col("n") / FAN)).alias("part"), "keys")
    most = many.agg(F.max("n")).first()[0] or 0

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        one = unions({tuple(x.tolist()) for x in pdf["keys"]})
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "part": [pdf["part"].iloc[0]], "keys": [one]})

    while True:
        now = cut(now.groupBy("host", "part").applyInPandas(merged, "host string, part long, keys array<long>"))
        if most <= FAN:
            return now.select("host", "keys")
        now, most = now.withColumn("part", F.floor(F.col("part") / FAN)), -(-most // FAN)


def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, place, text) of the texts of each page (host, keys, texts, wrapper) that meet its expression."""
    kept: dict[str, list] = {}
    for batch in batches:
        hosts, places, texts = [], [], []
        for host, keys, of_page, wrapper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for i, j in common(known(wrapper, kept)[0], keys):
                if of_page[j] != -1:
                    hosts.append(host)
                    places.append(i)
                    texts.append(of_page[j])
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(places, pa.int64()), pa.array(texts, pa.int64())], names=["host", "place", "text"])


def known(wrapper: str | None, kept: dict[str, list]) -> list:
    """Keys of an expression, the template's text at its places, and the number of the main region's path."""
    if wrapper is None:
        return [[], {}, None]
    if wrapper not in kept:
        if len(kept) > 1000:
            kept.clear()
        found = json.loads(wrapper)
        kept[wrapper] = [found.get("keys", []), {x["place"]: x["text"] for x in found.get("fixed", [])}, found.get("region")]
    return kept[wrapper]


def wrappers(streams: DataFrame) -> DataFrame:
    """(host, keys, fixed): the expression of all pages of a host that are not alike, and the template's texts at its
    places. Hosts where too few pages have anything in common have none."""
    pages = cut(streams.where("keys is not null").select("host", "digest", "keys", "texts").dropDuplicates(["host", "digest"]))
    sizes = cut(pages.groupBy("host").agg(F.count("*").alias("pages")))
    found = expressions(pages.select("host", "keys"), sizes)
    texts = met(pages, found.select("host", F.to_json(F.struct("keys")).alias("wrapper")), "digest").where("wrapper is not null")
    texts = texts.select("host", "keys", "texts", "wrapper").mapInArrow(matched, "host string, place long, text long")
    places = texts.groupBy("host", "place", "text").agg(F.count("*").alias("n")).groupBy("host", "place")
    places = places.agg(F.sum("n").alias("all"), F.max(F.struct("n", "text")).alias("top")).join(sizes, "host")
    fixed = places.where((F.col("top.n") >= least_of("pages")) & (F.col("top.n") >= AGREE * F.col("all")))
    fixed = fixed.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "top.text"))).alias("fixed"))
    return cut(found.join(fixed, "host", "left"))


def bodies(batch: pa.RecordBatch, kept: dict[str, list]) -> Iterator[tuple | None]:
    """Of each page (keys, texts, body, wrapper), its blocks, blank texts, paths, and places of the template's texts."""
    for keys, texts, body, wrapper in zip(*(batch.column(c).to_pylist() for c in ("keys", "texts", "body", "wrapper")), strict=True):
        if body is None:
            yield None
            continue
        paths = Paths()
        blocks, blank, paths.parent, paths.key = pickle.loads(body)
        paths.depth = [0]
        for parent in paths.parent[1:]:
            paths.depth.append(paths.depth[parent] + 1)
        wanted, fixed, region = known(wrapper, kept)
        template = {j for i, j in common(wanted, keys) if fixed.get(i) == texts[j]} if fixed else set()
        yield blocks, blank, paths, template, region


def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, digest, path, role, depth, free, every): characters of texts under each path of a page, and of these not the
    template's (null: no such text)."""
    kept: dict[str, list] = {}
    for batch in batches:
        rows: list[tuple] = []
        for host, digest, page in zip(batch.column("host").to_pylist(), batch.column("digest").to_pylist(), bodies(batch, kept), strict=True):
            if page:
                blocks, _, paths, template, _ = page
                every, there = masses([p for _, parts in blocks for p in parts], paths)
                free, own = masses([p for j, parts in blocks if j not in template for p in parts], paths)
                ids = ids_of(paths)
                rows += [(host, digest, ids[p], role(paths.key[p]), paths.depth[p], free[p] if own[p] else None, every[p]) for p in range(1, len(ids)) if there[p]]
        columns = list(zip(*rows, strict=True)) or [()] * 7
        types = [pa.string(), pa.binary(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["host", "digest", "path", "role", "depth", "free", "every"])


def regions(pages: DataFrame) -> DataFrame:
    """(host, region): the path of `region_of` over all texts of a host's pages that are not the template's, or over all
    texts where that is none."""
    rows = pages.select("host", "digest", "keys", "texts", "body", "wrapper").where("body is not null").mapInArrow(weighed, "host string, digest binary, path long, role long, depth long, free long, every long")
    rows = rows.dropDuplicates(["host", "digest", "path"]).groupBy("host", "path", "role", "depth").agg(F.sum("free").alias("free"), F.sum("every").alias("every"))
    rows = cut(rows)
    whole = rows.groupBy("host").agg(F.max("free").alias("most_free"), F.max("every").alias("most_every"))

    def best(mass: str) -> list:
        m = F.col(mass)
        article = F.max_by("path", F.when((F.col("role") == 0) & m.isNotNull(), F.struct(m, -F.col("depth"), "path")))
        box = F.max_by("path", F.when((F.col("role") == 1) & (m >= HELD * F.col(f"most_{mass}")), F.struct("depth", m, "path")))
        return [article, box]

    return rows.join(whole, "host").groupBy("host").agg(F.coalesce(*best("free"), *best("every"), F.lit(0)).alias("region"))


def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: dict[str, list] = {}
    for batch in batches:
        texts, through = [], []
        for page in bodies(batch, kept):
            text, wrapped = "", False
            if page:
                blocks, blank, paths, template, region = page
                found = [(None, None, None, None, None, parts) for _, parts in blocks], blank
                ids = ids_of(paths)
                if region in ids:
                    own = {n for n, (j, _) in enumerate(blocks) if j in template}
                    text, wrapped = main_text(found, paths, paths.keys(ids.index(region)), own)
                if not wrapped:
                    text, _ = main_text(found, paths, region_of([p for _, parts in blocks for p in parts], paths))
            texts.append(text)
            through.append(wrapped)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(through)], names=["page_id", "url", "text", "n_chars", "wrapped"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, wrapped (whether the host's wrapper fitted) of every page."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)", 1)), F.lit("")).alias("host"),
        F.col("html").cast("string").alias("html"),
    )
    streams = cut(rows.mapInArrow(read, STREAMS), compression="zstd")
    found = wrappers(streams)
    wrapper = F.to_json(F.struct("keys", "fixed")).alias("wrapper")
    spread = ("page_id", "url", "digest")
    region = regions(met(streams, found.select("host", wrapper), *spread))
    whole = cut(region.join(found, "host", "left").select("host", F.to_json(F.struct("keys", "fixed", "region")).alias("wrapper")))
    return met(streams, whole, *spread).select("page_id", "url", "keys", "texts", "body", "wrapper").mapInArrow(extracted, SCHEMA)
