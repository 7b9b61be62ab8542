import pytest

from campanula.llm import pii

CASES = [
    ("account", "account no. 1234-5678-9012-3456-7890-1234-5678-9012-3456 end", "1234-5678-9012-3456-7890-1234-5678-9012-3456"),
    ("account", "account number " + "7" * 40 + ", then", "7" * 40),
    ("account", "account number " + "7a" * 4000 + ", then", "7a" * 4000),
    ("account", "Konto-Nr. 12345678 bei uns", "12345678"),
    ("account", "KONTONUMMER: 1234 5678 9012.", "1234 5678 9012"),
    ("account", "numéro de compte : 00012345678", "00012345678"),
    ("account", "Número de cuenta 12-345-678", "12-345-678"),
    ("account", "account number 1234-5678-12ab-9 end", "1234-5678-12ab-9"),
    ("iban", "Iban: gb82 west 1234 5698 7654 32 then", "gb82 west 1234 5698 7654 32"),
    ("national_id", "numéro de sécurité sociale 1 85 05 78 006 084 91 ici", "1 85 05 78 006 084 91"),
    ("national_id", "DNI: 12345678Z, vive", "12345678Z"),
    ("national_id", "NIE X-1234567-L", "X-1234567-L"),
    ("secret", "password=correcthorsebatterystaple now", "correcthorsebatterystaple"),
    ("secret", "token ghp_16C7e42F292c6912E7710c838347Ae178B4a and", "ghp_16C7e42F292c6912E7710c838347Ae178B4a"),
    ("secret", "Passwort: geheim123", "geheim123"),
    ("street", "lives at 12 " + "L" + "o" * 200 + "ng Street now", "12 L" + "o" * 200 + "ng Street"),
    ("street", "wohnt Hauptstraße 12 in", "Hauptstraße 12"),
    ("street", "wohnt Lange Straße 3a in", "Lange Straße 3a"),
    ("street", "au 12 rue de la Paix, Paris", "12 rue de la Paix"),
    ("street", "en Calle Mayor 5 de", "Calle Mayor 5"),
]


@pytest.mark.parametrize("kind, text, value", CASES)
def test_values_go_to_their_own_boundary(kind, text, value):
    at = text.index(value)
    assert [s for s in pii.Scanner().spans(text) if s[0] == kind] == [(kind, at, at + len(value))]


@pytest.mark.parametrize("text", [
    "the password: required by all", "a secret: something else", "token of thanks", "on the avenue of trees", "account no idea",
    "12345 people walked the Street", "DNI: 12345678A", "numéro de sécurité sociale 1 85 05 78 006 084 37", "die Straße 5 mal", "AKIA and more",
    "un rue de la paix", "", "Street", "straße 1", "rue ", "12", "=", "token=",
])
def test_clean_texts_stay(text):
    assert [s for s in pii.Scanner().spans(text) if s[0] in pii.ADDED_KINDS] == []


def test_random_strings_of_cue_parts():
    """No crash, spans inside the text, spans of one kind apart."""
    import random
    rng = random.Random(3)
    parts = ["Calle ", "rue ", "de la ", "Mayor", " ", ", ", "5", "12", "straße", "Platz", " Street", "Long", "token", "=", ":", "ghp_", "a1b2c3d4e5",
             "dni", "konto-nr", ".", "-", "Iban", "GB82", "x", "é", "\n", "@", "+1"]
    scan = pii.Scanner()
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        ends = {}
        for k, s, e in scan.spans(t):
            assert 0 <= s < e <= len(t) and s >= ends.get(k, 0), (t, k, s, e)
            ends[k] = e
