from beaconry.profiles.base import Expectation, Penalty, Profile
from beaconry.profiles.network import NETWORK
from beaconry.profiles.retail import RETAIL

__all__ = ["Expectation", "NETWORK", "Penalty", "Profile", "RETAIL"]
