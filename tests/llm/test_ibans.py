"""IBANs that stand beside each other or behind a code that is none."""

import pytest

from telemetra.llm import pii

DE, GB, SPACED = "DE89370400440532013000", "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00"


@pytest.mark.parametrize("text,want", [
    (f"{DE} {GB}", [DE, GB]), (f"AB12 {DE}", [DE]), (f"AB12 CD34 {SPACED} {GB} X", [SPACED, GB]),
    (f"{GB} {DE} {SPACED}", [GB, DE, SPACED]), (f"x{DE} {GB}", [GB]), (f"{DE}{GB}", []),
    (f"GB00WEST12345698765432 {DE}", [DE]), ("", [])])
def test_ibans(text, want):
    assert [text[a:b] for a, b in pii.ibans(text)] == want
    assert [x for kind, _, _, x, _ in pii.find_spans(text) if kind == "iban"] == want
