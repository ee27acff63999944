from dosewise.sources import adapter, tables  # noqa: F401
