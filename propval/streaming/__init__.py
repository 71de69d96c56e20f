"""Streaming use of the batch column logic.

The reference workload has no streams (no watermark, window, trigger or
state).  The feature expressions are pure column functions, so the same
code runs on a streaming DataFrame; this package only wires that up.
"""
