"""Training-data operators: tokens, media, licences, pages, archives, near copies and packing.

Nothing outside this subpackage imports it.
"""
