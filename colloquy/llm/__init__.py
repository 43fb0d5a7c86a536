"""Operators for preparing training data: mixing, packing, dedup, media, sharding, counting, filtering, chat.

Nothing outside this subpackage imports it.
"""
