"""Planted secrets and look-alikes: how many are found, how many are left alone."""

import random
import string

import pytest

from lexiloom.llm import secrets

maker = random.Random(17)
LETTERS, LOWER, HEX, BASE64 = string.ascii_letters + string.digits, string.ascii_lowercase + string.digits, "0123456789ABCDEF", string.ascii_letters + string.digits + "+/"


def token(alphabet, n):
    return "".join(maker.choice(alphabet) for _ in range(n))


# What stands before and behind a secret: in prose, in settings, in every part of an address.
PLACES = [
    ("see ", " now"), ("key=", ";"), ('"', '"'), ("https://user:", "@host.example.org/x"), ("postgres://svc:", "@db:5432/main"),
    ("https://hooks.service.io/services/T024/", ""), ("https://api.io/v1/items?sig=", "&page=2"), ("https://api.io/" + "long/" * 40 + "?k=", ""),
    ("md5 ", " of"), ("Authorization: Bearer ", "\n"), ("commit: ", ""), ("http://a.b#", ""),
]
SHAPES = [lambda: "ghp_" + token(LETTERS, 36), lambda: token(BASE64, 40), lambda: token(LETTERS, 24), lambda: token(LOWER, 32), lambda: token(LETTERS, 64), lambda: "sk-" + token(LETTERS, 48)]
HARMLESS = [
    "thisIsAVeryLongCamelCaseName2WithDigit", "some_long_identifier_name_42_with_numbers", "antidisestablishmentarianism1",
    "https://cdn.site.org/assets/9f86d081884c7d659a2feaa0/app.js", "https://d111111abcdef8x9y2z7.cloudfront.net/index.html",
    "sha256: 9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B2B0B822CD15D6C15B0F00A08", "550e8400-e29b-41d4-a716-446655440000",
    "src/main/java/org/acme/Version2Helper", "https://news.org/2024/05/17/a-bridge-for-the-valley-is-3-years-late", "YOUR-API-KEY-XXXXXXXX-HERE-1",
    "internationalization_v2_of_the_settings", "commit 9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B", "2024-01-02T03:04:05+00:00", "0123456789012345678901234567890",
    "MD5 = D41D8CD98F00B204E9800998ECF8427E", "getElementsByClassName3AndTagName", "https://shop.org/products/red-running-shoes-size-42-for-women",
]


def test_recall():
    """At least nine in ten of each shape in each place, and each to its last character."""
    for before, after in PLACES:
        for shape in SHAPES:
            found = whole = 0
            for _ in range(60):
                secret = shape()
                text = before + secret + after
                spans = secrets.find_spans(text)
                covered = {i for a, _, b in spans for i in range(a, b)}
                mine = set(range(len(before), len(before) + len(secret)))
                found += bool(covered & mine)
                whole += mine - {len(before) + i for i, c in enumerate(secret) if c in "+/"} <= covered
            assert found >= 54 and whole >= 0.8 * found, (before, shape(), found, whole)


@pytest.mark.parametrize("text", HARMLESS)
def test_precision(text):
    assert [s for s in secrets.find_spans(f"see {text} here") if secrets.KINDS[s[1]] == "entropy"] == []


def test_an_address_is_the_same_however_long():
    secret = "xK9vQ2mZ7pLw4TbN8cRy"
    for n in (0, 1, 100, 10_000):
        text = "https://host.org/" + "p/" * n + "?t=" + secret
        assert [text[a:b] for a, _, b in secrets.find_spans(text)] == [secret]


def test_placeholders_do_not_cover_for_secrets():
    secret = "xK9vQ2mZ7pLw4TbN8cRy5dFg"
    assert secrets.find_spans(f"{secret}xxxx") and secrets.find_spans(f"example_{secret}")
    assert secrets.find_spans("AKEXAMPLEKEY1EXAMPLE2xxxxxxxx") == []
