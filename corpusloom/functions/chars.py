"""Character classes that agree over engines; for use inside [...] of a Java regular expression."""

# Classes that stand for Python's isspace, isalpha, \w and digits inside words.
SPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"
LETTER = r"\p{L}"
WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨"
