"""Cutting texts where a byte-level tokenizer cuts them before it merges.

A text is first cut into chunks: white space and what follows it up to the next white space. No pre-split word crosses a
chunk, as every rule of the splitting pattern either starts at white space or ends before it, and none looks back. So what
is known of a chunk holds wherever it occurs.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

# The splitting pattern of byte-level tokenizers, with the classes of letters, numbers and white space open.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def ranges(found: list[tuple[int, int]]) -> str:
    """The inside of a character class for half-open ranges of code points."""
    return "".join(re.escape(chr(a)) if b == a + 1 else f"{re.escape(chr(a))}-{re.escape(chr(b - 1))}" for a, b in found)


def character_classes() -> dict[str, str]:
    """Letters, numbers and white space as the tokenizers library's own regular expressions have them."""
    from tokenizers import Regex, pre_tokenizers

    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    every, out = "".join(map(chr, points)), {}
    for name, kind in {"L": "\\p{L}", "N": "\\p{N}", "S": "\\s"}.items():
        others = pre_tokenizers.Split(Regex(f"{kind}+"), "removed").pre_tokenize_str(every)
        edges = [0, *[x for _, span in others for x in span], len(every)]
        spans = [(edges[i], edges[i + 1]) for i in range(0, len(edges), 2) if edges[i] < edges[i + 1]]
        out[name] = ranges([(points[a], points[b - 1] + 1) for a, b in spans])
    return out


@dataclass(frozen=True)
class Layout:
    """What a tokenizer file says about cutting: the splitting pattern, chunks, and texts of tokens that stand whole."""

    words: str
    chunks: str
    whole: dict[str, int]


def layout(file: str) -> Layout:
    """Read a byte-level tokenizer file. Others, and added tokens with options, are refused."""
    with open(file, encoding="utf-8") as f:
        spec = json.load(f)
    before = spec["pre_tokenizer"] or {}
    if spec["model"]["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec["normalizer"]:
        raise ValueError("only byte-level BPE without a normalizer or a prefix space is known")
    for token in spec["added_tokens"]:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"added token {token['content']!r} has options that are not known")
    sets = character_classes()
    space = sets["S"]
    words = PATTERN.replace("{L}", sets["L"]).replace("{N}", sets["N"]).replace("{S}", space)
    return Layout(words, f"[{space}]*[^{space}]+|[{space}]+", {t["content"]: t["id"] for t in spec["added_tokens"]})


class Cutter:
    """Compiled patterns of a layout."""

    def __init__(self, plan: Layout):
        self.words = re.compile(plan.words).findall
        self.chunks = re.compile(plan.chunks).findall
        self.whole = plan.whole
        marks = sorted(plan.whole, key=len, reverse=True)
        self.marks = re.compile(f"({'|'.join(map(re.escape, marks))})") if marks else None

    def parts(self, text: str) -> list[str]:
        """Chunks of a text, and tokens that stand whole, in order."""
        if self.marks is None or not any(mark in text for mark in self.whole):
            return self.chunks(text)
        out = []
        for i, part in enumerate(self.marks.split(text)):
            out += [part] if i % 2 else self.chunks(part)
        return out
