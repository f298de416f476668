"""Names of fields that group documents."""


def taxonomy_key(name: str) -> bool:
    """categories, tags and custom taxonomies ending in _category or _categories."""
    return name in ("categories", "tags") or name.endswith(("_category", "_categories"))
