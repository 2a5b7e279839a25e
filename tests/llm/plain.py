"""Plain forms that several brute-force versions share."""

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def ascii_lower(text):
    return None if text is None else text.translate(LOWER)
