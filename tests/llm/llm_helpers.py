"""What several modules of this folder use."""


def thue_morse(levels, other=False):
    """A word of 2 ** levels letters that hashes with powers of a base modulo
    2 ** 64 cannot tell from its complement (from 1,024 letters on)."""
    s = "ab" if not other else "ba"
    for _ in range(levels - 1):
        s += s.translate(str.maketrans("ab", "ba"))
    return s


def twin_texts():
    """Texts alike but for such words."""
    out = {}
    for levels in (10, 11):
        for other in (False, True):
            w = thue_morse(levels, other)
            out[len(out)] = w
            out[len(out)] = f"{w} and {w} again, {w}!"
            out[len(out)] = f"some words before {w} " + "tail of it " * 3
    return out
