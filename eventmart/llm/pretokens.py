"""Split texts into the pieces that byte-level BPE merges separately."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import public_tokenizers
import regex

_ANY = regex.compile(public_tokenizers.PATTERN)

# the same pattern over U+0000..U+00FF with its classes written out: letters, numbers and white
# space of that range. The standard module runs it twice as fast.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
_NARROW = re.compile(
    rf" ?[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)

WHOLE = 1 << 20  # longer texts are split lazily
RUN = 1 << 17  # pieces of such a text held at a time


def _pattern(text: str):
    if text.isascii():
        return _NARROW
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _ANY
    return _NARROW


def runs(text: str) -> Iterator[list[str]]:
    """The pieces of one text, in lists of bounded length; their concatenation is the text."""
    pattern = _pattern(text)
    if len(text) <= WHOLE:
        yield pattern.findall(text)
        return
    found = (m.group() for m in pattern.finditer(text))
    while part := list(islice(found, RUN)):
        yield part


def grouped_runs(texts: list[str]) -> Iterator[list[tuple[int, list[str]]]]:
    """(text number, pieces) in groups of about WHOLE characters."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for part in runs(text):
            group.append((i, part))
            size += sum(map(len, part)) if len(text) > WHOLE else len(text)
            if size >= WHOLE:
                yield group
                group, size = [], 0
    if group:
        yield group
