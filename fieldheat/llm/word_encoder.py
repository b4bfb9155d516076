"""Token ids of texts, encoded word by word with the words that return kept."""

from __future__ import annotations

import array
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import compress, count
from operator import not_

from fieldheat.llm.common import safe_pieces

GROUP_BYTES = 1 << 20
KEPT_WORDS = 500_000
KEPT_LENGTH = 64
# Letters a-z, then ASCII marks other than the apostrophe.
PLAIN = re.compile(rb"([a-z]+)([!-&(-/:-@\[-`{-~]*)")


def groups_by_bytes(texts: Iterable[bytes], limit: int = GROUP_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """Texts as groups of about equal bytes: (number of the text, piece of it), in order."""
    group: list[tuple[int, bytes]] = []
    size = 0
    for number, text in enumerate(texts):
        for piece in safe_pieces(text, limit):
            if group and size + len(piece) > limit:
                yield group
                group, size = [], 0
            group.append((number, piece))
            size += len(piece)
    if group:
        yield group


class WordEncoder:
    """Ids as the tokenizers library gives them, without added special tokens.

    The tokenizer must treat white space as a border that no token crosses and that leaves no token
    (`white_space_is_border` checks the file for that). Special strings inside a text hold no white space, so
    they fall into one word and are treated there as by default.

    Words stay in memory in two generations of up to KEPT_WORDS: a full one takes the other's place, and words that
    are met again move on, so that frequent words stay and rare ones go. If the tokenizer lower-cases, A-Z are lower-cased
    beforehand, which leaves fewer words, except in pieces that hold a special string in some case.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kept: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.marks: dict[bytes, bytes] = {}
        self.model = self.tokenizer.model
        self.plain = letters_are_whole(path)
        rules = rules_of(path)
        self.lowers = any(s.get("type") == "Lowercase" for s in normalizers(rules))
        self.special = [t["content"].encode().lower() for t in rules.get("added_tokens", [])]

    def words(self, piece: bytes) -> list[bytes]:
        if self.lowers:
            lower = piece.lower()
            if not any(s in lower for s in self.special):
                piece = lower
        return piece.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit little-endian integers."""
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array.array("I", e.ids).tobytes() for e in encoded]

    def part(self, text: str) -> bytes:
        """Ids of a text that is one token before merging, straight from the model."""
        return array.array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def learn(self, words: set[bytes]) -> None:
        """Take words over from the older generation, encode the others."""
        other = []
        for word in words:
            known = self.older.get(word)
            if known is not None:
                self.kept[word] = known
            elif self.plain and (parts := PLAIN.fullmatch(word)):
                letters, marks = parts.groups()
                if marks not in self.marks:
                    self.marks[marks] = self.part(marks.decode()) if marks else b""
                self.kept[word] = self.part(letters.decode()) + self.marks[marks]
            else:
                other.append(word)
        self.kept.update(zip(other, self.encode([w.decode("utf-8", "replace") for w in other])))

    def pieces(self, texts: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
        """(number of the text, ids of its next piece), in order."""
        for group in groups_by_bytes(texts):
            if len(self.kept) > KEPT_WORDS:
                self.kept, self.older = {}, self.kept
            if len(self.marks) > KEPT_WORDS // 10:
                self.marks.clear()
            words = [self.words(piece) for _, piece in group]
            found = [list(map(self.kept.get, own)) for own in words]
            new = set().union(*(compress(own, map(not_, ids)) for own, ids in zip(words, found)))
            self.learn(new)
            for (number, _), own, ids in zip(group, words, found):
                for place in list(compress(count(), map(not_, ids))):
                    ids[place] = self.kept[own[place]]
                yield number, b"".join(ids)
            for long_word in [w for w in new if len(w) > KEPT_LENGTH]:
                del self.kept[long_word]


class WholeEncoder(WordEncoder):
    """For other tokenizers: whole texts, never cut."""

    def pieces(self, texts: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
        group: list[tuple[int, bytes]] = []
        size = 0
        for number, text in enumerate(texts):
            group.append((number, text))
            size += len(text)
            if size > GROUP_BYTES:
                yield from self._whole(group)
                group, size = [], 0
        yield from self._whole(group)

    def _whole(self, group: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        yield from zip((n for n, _ in group), self.encode([t.decode("utf-8", "replace") for _, t in group]))


def rules_of(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def normalizers(rules: dict) -> list[dict]:
    normal = rules.get("normalizer") or {}
    return normal.get("normalizers", [normal])


def white_space_is_border(path: str) -> bool:
    """Whether the file's own rules drop white space and start anew after it.

    True for normalizers that map each run of white space to one space and otherwise work on characters (NFC,
    lower case), followed by a split that keeps only matches without white space.
    """
    rules = rules_of(path)
    local = all(
        s.get("type") in ("NFC", "Lowercase")
        or (s.get("type") == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " ")
        for s in normalizers(rules)
    )
    before = rules.get("pre_tokenizer") or {}
    first = before.get("pretokenizers", [before])[0]
    pattern = first.get("pattern", {}).get("Regex", " ") if first.get("type") == "Split" else " "
    drops = first.get("behavior") == "Removed" and first.get("invert") and not re.search(r"\s|\.", pattern)
    # White space may be named inside negated classes only.
    negated = all("^" in c for c in re.findall(r"\[[^\]]*\\s[^\]]*\]", pattern))
    outside = re.sub(r"\[[^\]]*\]", "", pattern)
    added = rules.get("added_tokens", [])
    special = not any(re.search(r"\s", t["content"]) for t in added)
    strips = any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
    return bool(local and drops and negated and r"\s" not in outside and special and not strips)


def letters_are_whole(path: str) -> bool:
    """Whether a-z alone, and ASCII marks alone, each reach the model as they are, as one token before merging.

    So if the normalizers leave them as they are and the split's pattern keeps runs of letters and runs of marks
    whole, its other alternatives beginning with an apostrophe or being about numbers.
    """
    rules = rules_of(path)
    steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if [s.get("type") for s in steps] != ["Split", "ByteLevel"] or not white_space_is_border(path):
        return False
    choices = steps[0]["pattern"].get("Regex", "").split("|")
    rest = {c for c in choices if not c.startswith("'")} - {r"[\p{N}]", r"\p{N}"}
    return rest == {r"[\p{L}]+", r"[^\s\p{L}\p{N}]+"} and not steps[1].get("add_prefix_space")


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder a Python worker, so that known words outlive a task."""
    return (WordEncoder if white_space_is_border(path) else WholeEncoder)(path)
