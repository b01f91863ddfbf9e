"""Column names in schema texts and selections."""


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
