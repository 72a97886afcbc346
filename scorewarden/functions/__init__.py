from .scalar import *  # noqa: F401,F403
