"""Rule sets from small seed tables, compiled on the driver into column expressions.

The literals of a taxonomy become one trie, written as one pattern, so a text is read once
for all of them and each of its positions is followed only as far as some literal goes: a
further rule adds a branch, not a pass. Alternatives that are patterns keep a test each.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = list[tuple[str, str]]  # (keywords: alternatives of a regular expression, label)

_META = set(".^$*+?()[]{}|")
_ESCAPED = set(".+#-/&")


def rules(rows: list[dict], label: str) -> Rules:
    """(keywords, label) of the seed rows that have both, in order."""
    return [(r["keywords"], r[label]) for r in rows if r.get("keywords") and r.get(label)]


def trie_pattern(words: list[str]) -> str:
    """A pattern for any of ``words``, the longest first, whose branches differ in their first character."""
    root: dict = {}
    for word in words:
        node = root
        for ch in word:
            node = node.setdefault(ch, {})
        node[""] = {}

    def written(node: dict) -> str:
        ends = "" in node
        branches = [_escaped(ch) + written(node[ch]) for ch in sorted(node) if ch]
        if not branches:
            return ""
        if len(branches) == 1 and not ends:
            return branches[0]
        return "(?:" + "|".join(branches) + ")" + ("?" if ends else "")

    return written(root)


def _escaped(ch: str) -> str:
    return ch if ch.isalnum() or ord(ch) > 127 else "\\" + ch if ch.isprintable() else f"\\x{ord(ch):02x}"


def bound(c: Column, of: Callable[[Column], Column]) -> Column:
    """``of(c)`` with ``c`` evaluated once, however often ``of`` uses it."""
    return F.get(F.transform(F.array(c), of), F.lit(0))


@dataclass
class Matcher:
    """J-09: which rules of a set occur anywhere in a text, in one pass for all literals."""

    #: Each literal with the rules that hold where it is the longest one found: its own and those of its beginnings.
    literals: dict[str, list[int]]
    patterns: list[tuple[int, str]]

    @staticmethod
    def build(ruled: Rules) -> Matcher:
        literals: dict[str, list[int]] = {}
        patterns = []
        for k, (keywords, _) in enumerate(ruled):
            parts = [keywords] if set(keywords) & set("()[]{}") else keywords.split("|")
            for part in parts:
                if set(part) & _META or "\\" in part or not part:
                    patterns.append((k, part))
                else:
                    literals.setdefault(part.lower(), []).append(k)
        return Matcher({w: sorted({k for v, ks in literals.items() if w.startswith(v) for k in ks}) for w in literals}, patterns)

    def found(self, text: Column) -> Column:
        """Numbers of the rules that occur, unsorted and maybe repeated; ``text`` is one that was bound."""
        out = [F.array().cast("array<int>")]
        if self.literals:
            # At each position the longest literal, by looking ahead, so that matches may overlap.
            firsts = "".join(sorted({re.sub(r"([\]\[\\^&-])", r"\\\1", w[0]) for w in self.literals}))
            pattern = f"(?=[{firsts}])(?=({trie_pattern(list(self.literals))}))"
            numbers = F.create_map(*[x for w, ks in self.literals.items() for x in (F.lit(w), F.array(*map(F.lit, ks)))])
            hits = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1)))
            out.append(F.flatten(F.transform(hits, lambda h: F.element_at(numbers, h))))
        if self.patterns:
            out.append(F.array_compact(F.array(*[F.when(text.rlike(f"(?iuU)({p})"), F.lit(k)) for k, p in self.patterns])))
        return F.concat(*out)


def first_match(c: Column, ruled: Rules) -> Column:
    """J-09, single label: the first rule whose keywords occur anywhere, case-insensitively; else null."""
    if not ruled:
        return F.lit(None).cast("string")
    labels = F.array(*[F.lit(label) for _, label in ruled])
    matcher = Matcher.build(ruled)
    return bound(c, lambda text: F.get(labels, F.array_min(matcher.found(text))))


def any_match(c: Column, ruled: Rules) -> Column:
    """J-09, many labels: every rule that matches, sorted and distinct; empty for null text."""
    if not ruled:
        return F.array().cast("array<string>")
    labels = F.array(*[F.lit(label) for _, label in ruled])
    matcher = Matcher.build(ruled)
    found = bound(F.coalesce(c, F.lit("")), lambda text: F.transform(F.array_distinct(matcher.found(text)), lambda k: F.get(labels, k)))
    return F.array_sort(F.array_distinct(found))


def ordered_flags(c: Column, level: Rules, flags: Rules) -> Column:
    """C-07: the first matching level, then each matching flag, in rule order."""
    parts = [first_match(c, level), *[F.when(c.rlike(f"(?U){p}"), F.lit(v)) for p, v in flags]]
    return F.array_compact(F.array(*parts))


def classify(alternative: str) -> tuple[str | None, str | None]:
    """(literal, None) or (None, regex) of one keyword alternative; (None, None) if blank.

    One word border at either end is dropped, some escaped characters are literal, any
    other escape or metacharacter makes the alternative a regular expression.
    """
    whole = alternative.strip()
    if not whole:
        return None, None
    inner = whole.removeprefix("\\b").removesuffix("\\b")
    plain = re.sub(r"\\([.+#\-/&])", lambda m: f"\0{m[1]}", inner)
    bare = re.sub("\0.", "", plain)
    if "\\" in bare or set(bare) & _META:
        return None, whole
    literal = plain.replace("\0", "").strip()
    return (literal, None) if literal else (None, None)


@dataclass
class KeywordSet:
    """X-01: literals (lower case to label; the last row wins) and the regular expressions after them."""

    literals: dict[str, str]
    regexes: Rules

    @staticmethod
    def build(ruled: Rules) -> KeywordSet:
        literals: dict[str, str] = {}
        regexes: Rules = []
        for keywords, label in ruled:
            for part in keywords.split("|"):
                literal, regex = classify(part)
                if literal:
                    literals[literal.lower()] = label
                elif regex:
                    regexes.append((regex, label))
        return KeywordSet(literals, regexes)

    def extract(self, c: Column) -> Column:
        """Labels found: literals in text order (leftmost-longest, no word character beside
        them), then regular expressions in rule order; distinct; empty for null text."""
        labels = F.create_map(*[F.lit(x) for pair in self.literals.items() for x in pair]) if self.literals else None

        def of(text: Column) -> Column:
            found = F.array().cast("array<string>")
            if labels is not None:
                pattern = f"(?<![A-Za-z0-9_])(?:{trie_pattern(list(self.literals))})(?![A-Za-z0-9_])"
                found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda k: F.element_at(labels, k))
            if self.regexes:
                found = F.concat(found, F.array_compact(F.array(*[F.when(text.rlike(f"(?iuU){p}"), F.lit(v)) for p, v in self.regexes])))
            return F.array_distinct(found)

        return bound(F.lower(F.coalesce(c, F.lit(""))), of)
