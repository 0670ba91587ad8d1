"""License scan of blocks that hold several licenses."""

from __future__ import annotations

import pytest

from eventmart.llm import licenses


def test_every_short_license_of_one_block_is_found():
    short = {k: t for k, t in licenses.TEMPLATES.items() if len(t) < 90}
    text = "Parts of this page:\n" + "\n".join(short.values()) + "\nThe end."
    got = {h[2]: text[h[0] : h[1]] for h in licenses.scan_text(text)}
    assert len(short) > 6 and got == {k: t.rstrip(".") for k, t in short.items()}


@pytest.mark.parametrize("times", [2, 3, 60])
def test_a_license_is_found_wherever_it_stands(times):
    """Twice in a stretch, and as headers of joined files that are read in blocks."""
    for name, text in licenses.TEMPLATES.items():
        for gap in ("\n", "\nint main() { return 0; }\nand so on\n"):
            joined = gap.join([text] * times)
            want = [(i * (len(text) + len(gap)), name, 0) for i in range(times)]
            got = [(h[0], h[2], h[4]) for h in licenses.scan_text(joined)]
            assert got == want


def test_a_reworded_license_is_found_behind_its_first_words():
    """Words of the license that stand earlier in the block are not its start."""
    for name in ("GPL-3.0-notice", "MIT-notice", "ISC", "BSD-3-Clause", "Apache-2.0-notice", "MPL-2.0"):
        first, rest = licenses.TEMPLATES[name].split(" ", 1)
        reworded = "Thus " + rest
        stray = f"{first} licensed permission " + " ".join(f"w{i}" for i in range(30)) + "\n"
        text = stray + reworded
        hits = licenses.scan_text(text)
        assert [(h[2], h[4]) for h in hits] == [(name, 1)]
        assert text[hits[0][0] :].startswith(rest)


def test_neighbours_of_a_shortened_license_stay():
    cut = licenses.TEMPLATES["ISC"].rsplit(" ", 1)[0]
    text = f"{licenses.TEMPLATES['MIT']}\n{cut}\n{licenses.TEMPLATES['MIT']}"
    assert [h[2] for h in licenses.scan_text(text)] == ["MIT", "ISC", "MIT"]
