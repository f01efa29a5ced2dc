"""Valid values are found beside whatever their form would take in with them."""

from __future__ import annotations

import pytest

from tidegate.llm import pseudonyms

CARD, IBAN = "4111 1111 1111 1111", "DE89370400440532013000"


@pytest.mark.parametrize(
    "text, kinds",
    [
        (f"{CARD} 12/27", {"card": 1}), (f"{CARD} 123", {"card": 1}), (f"2 {CARD}", {"card": 1}), (f"22 33 {CARD}", {"card": 1}), (f"{CARD} {CARD}", {"card": 2}),
        (f"no. 10 20 30 40 {CARD} 50 60 70", {"card": 1}), ("7 4111111111111111 8", {"card": 1}), (f"+{CARD}", {"card": 1}), (f"{CARD} 123-45-6789", {"card": 1, "ssn": 1}), (f"{CARD} 12/24/2024", {"card": 1, "date": 1}),
        (f"{IBAN} 100 EUR", {"iban": 1}), (f"{IBAN} BIC COBADEFF", {"iban": 1}), ("DE89 3704 0044 0532 0130 00 I paid", {"iban": 1}), (f"AB12 {IBAN}", {"iban": 1}), (f"{IBAN} {CARD}", {"iban": 1, "card": 1}),
    ],
)
def test_neighbours_do_not_hide_a_value(text, kinds):
    new, counts = pseudonyms.pseudonymise(text, b"key")
    assert counts == kinds and len(new) == len(text)
    for value in (CARD, IBAN, "DE89 3704 0044 0532 0130 00", "4111111111111111", "123-45-6789"):
        assert value not in new
    assert new.startswith(text[: len(text) - len(text.lstrip("2 "))]) and (not text.endswith("100 EUR") or new.endswith(" 100 EUR"))


def test_invalid_values_stay():
    for text in ("4111 1111 1111 1112 12/27", "DE89370400440532013001 100 EUR", "1 2 3", "12345678901234567890123"):
        assert pseudonyms.pseudonymise(text, b"key") == (text, {})
