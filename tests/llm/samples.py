"""Odd texts for every operator."""

#: Texts that every operator must take.
ODD = [None, "", " \t\n", "x", "x", "\n\n\n", "ä" * 5000, "word " * 30000, "\u0000\ud7ff e\u0301 \U0001f600", "\r\nA\r\nb", "</turn>###\\"]
