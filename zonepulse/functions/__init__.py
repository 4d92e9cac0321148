from .calendar import *  # noqa: F401,F403
