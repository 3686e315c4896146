"""Java lexing as pure column expressions.

A lexeme is one match of a single regular-expression alternation, so a whole
text is tokenised inside the JVM by one ``regexp_extract_all``; no Python
function ever sees a row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The lexeme contract.  `\p{Z}` and the control ranges spell out
# the Unicode notion of white space, since `\s` is ASCII-only in Java.
WHITESPACE = r"\t-\r\x1C-\x20\x85\p{Z}"
WHITESPACE_CHARACTERS = "".join(
    chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B))
) + "\u2028\u2029\u202f\u205f\u3000"
LINE_BREAKS = r"\n-\r\x1C-\x1E\x85\x{2028}\x{2029}"
INLINE_SPACE = r"\t\x1F\p{Zs}"

LINE_COMMENT = r"//[^\n]*"
BLOCK_COMMENT = r"/\*[\s\S]*?\*/"
# `*+` is possessive: the JVM matches it in a loop instead of recursing, so a
# literal of any length cannot overflow the stack.
TEXT_BLOCK = r'"""\n(?:[^"\\]|\\[\s\S]|""?[^"\\]|""?\\[\s\S])*+(?:""")?'
STRING = TEXT_BLOCK + "|" + r'"(?:[^"\\]|\\[\s\S])*+"?'
CHARACTER = r"'\\[\s\S]'|'[^\\]'|'\\u[0-9a-fA-F]{4}'"
ANNOTATION = r"@[\p{L}\p{Nl}\p{No}_][\p{L}\p{N}_.]*"
IDENTIFIER = r"[\p{L}\p{Nl}\p{No}_$][\p{L}\p{N}_$]*"
FLOAT = (
    r"(?:[0-9][0-9_]*\.(?:[0-9][0-9_]*)?|\.[0-9][0-9_]*)(?:[eE][+-]?[0-9][0-9_]*)?[fFdD]?"
    r"|[0-9][eE][+-]?[0-9][0-9_]*[fFdD]?"
    r"|[0-9][fFdD]"
)
INTEGER = (
    r"0[xX][0-9a-fA-F][0-9a-fA-F_]*[lL]?"
    r"|0[bB][01][01_]*[lL]?"
    r"|0[0-7_]+[lL]?"
    r"|0|[1-9][0-9_]*[lL]?"
)
ANY_OTHER = f"[^{WHITESPACE}]"
STRING_PIECE = r'"""\n|"""|[^\\"]+|\\\\|\\"|\\|"'
OPERATORS = ("~", "^", "*", "!", "%", "&", "[", "]", "<", ">", "|", "+", "=", "/", "?", "-")

# Identifiers come first because they are the commonest lexeme and no other
# alternative can start with one of their first characters.
LEXEME = "|".join(
    [IDENTIFIER, LINE_COMMENT, BLOCK_COMMENT, STRING, CHARACTER, ANNOTATION, FLOAT, INTEGER, ANY_OTHER]
)
LEXEME_OR_SPACE = f"[{WHITESPACE}]+|{LEXEME}"


def unify_line_ends(code: Column) -> Column:
    return F.replace(F.replace(code, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def lexer_input(code: Column) -> Column:
    """Unify line ends and end the text with exactly one line feed.

    The closing line feed becomes part of a string literal left open at the
    end of the text, which is what the lexer contract asks for.
    """
    return F.concat(F.btrim(unify_line_ends(code), F.lit("\n")), F.lit("\n"))


def is_comment(lexeme: Column) -> Column:
    return lexeme.startswith("//") | lexeme.startswith("/*")


def lexemes(code: Column, keep_space: bool = False) -> Column:
    """All lexemes of a text, comments included, string literals kept whole."""
    pattern = LEXEME_OR_SPACE if keep_space else LEXEME
    return F.regexp_extract_all(lexer_input(code), F.lit(pattern), F.lit(0))


def tokenize_code(code: Column) -> Column:
    """Tokens of a Java text; an empty array for a null, blank or comment-only text.

    Comments are dropped; quotes, escapes and plain runs of a string literal
    are separate tokens.  Texts with neither skip the per-lexeme pass.
    """
    found = lexemes(code)
    refined = F.flatten(
        F.transform(
            found,
            lambda lexeme: F.when(is_comment(lexeme), F.array().cast("array<string>"))
            .when(
                lexeme.startswith('"'),
                F.regexp_extract_all(lexeme, F.lit(STRING_PIECE), F.lit(0)),
            )
            .otherwise(F.array(lexeme)),
        )
    )
    special = code.contains('"') | code.contains("//") | code.contains("/*")
    return F.coalesce(F.when(special, refined).otherwise(found), F.array().cast("array<string>"))


def strip_comments(code: Column) -> Column:
    """Drop comments, break lines at braces and semicolons, space out operators."""
    spaced = F.transform(
        lexemes(code, keep_space=True),
        lambda lexeme: F.when(is_comment(lexeme), "")
        .when(lexeme == "{", " {\n")
        .when(lexeme == "}", "\n}\n")
        .when(lexeme == ";", ";\n")
        .when(lexeme.isin(*OPERATORS), F.concat(F.lit(" "), lexeme, F.lit(" ")))
        .otherwise(lexeme),
    )
    return F.coalesce(F.array_join(spaced, ""), F.lit(""))


def normalise_whitespace(code: Column) -> Column:
    """Trim lines, drop blank ones, collapse inner runs to one space.

    In other words: a run of white space becomes a line feed when it holds a
    line break and one space otherwise, and none is kept at either end.
    """
    one_space = F.regexp_replace(code, f"[{INLINE_SPACE}]+", " ")
    one_break = F.regexp_replace(one_space, f" ?[{LINE_BREAKS}][{LINE_BREAKS} ]*", "\n")
    return F.coalesce(F.btrim(one_break, F.lit(" \n")), F.lit(""))


def clean_code(code: Column) -> Column:
    """Comment removal followed by white-space normalisation."""
    return normalise_whitespace(strip_comments(code))
