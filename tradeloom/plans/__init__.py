from tradeloom.plans.feeds import FEEDS, feed
from tradeloom.plans.runner import build, check_feed, run_all, run_feed

__all__ = ["FEEDS", "build", "check_feed", "feed", "run_all", "run_feed"]
