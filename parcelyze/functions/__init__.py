from .rules import *  # noqa: F401,F403
