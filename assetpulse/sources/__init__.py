from assetpulse.sources.files import *  # noqa: F401,F403
from assetpulse.sources.jdbc import *  # noqa: F401,F403
