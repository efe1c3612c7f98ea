"""Operators for preparing training data: token files, sharding, language and personal-data
detection, archives, exact and near duplicates, benchmark decontamination, token counts and
piece encoding.  Nothing outside this subpackage imports it; ``queries`` holds the
registered queries and their SQL."""
