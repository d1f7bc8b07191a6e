"""Micro-batch adaptors.

The lending and game analyses have no streaming operator (every input is a
finite file).  The only adaptor here runs the batch standings operator
(G24 + G25) over a file stream of battle results, so standings can be kept
current as battles land.
"""

from ledgerplay.streaming.standings import standings_stream  # noqa: F401
