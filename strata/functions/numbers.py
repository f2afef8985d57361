"""The number text that rules and typing accept, ahead of a cast.

Spark's casts also take Java forms (``5d``, ``1.5f``, ``0x1p3``); loaders read plain
decimal numbers, infinities and NaN, with white space around them.
"""

#: Java regular expression of a whole number text.
NUMBER = (r"\A\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
          r"|(?i:inf|infinity|nan))\s*\z")
