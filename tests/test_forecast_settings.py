"""What the fitted forecasts are registered with."""

from tideline.plans import catalog_forecast
from tideline.plans import forecasting as fc


def test_fitted_queries_take_the_whole_settings():
    for _, plan in catalog_forecast._entries_model.values():
        assert plan.keywords == {"s": fc.Settings()} and not plan.args
