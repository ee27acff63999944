from dosewise.functions.scalars import *  # noqa: F401,F403
