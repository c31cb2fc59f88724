"""Rows that every operator must survive."""

ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one"), (None, "null id words here"), (6, "a b c d e f g h " * 20000),
       (7, "日本語 текст ünïcode\xa0\xa0 mixed"), (7, "same id again"), (7, "same id again"), (8, "😀"), (9, "# $ % & * | < >")]
