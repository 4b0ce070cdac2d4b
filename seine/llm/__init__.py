"""Operations for preparing training text: tokens, quality, duplicates, secrets, filters, search.

Nothing outside this subpackage imports it.
"""
