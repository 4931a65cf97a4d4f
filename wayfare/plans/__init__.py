from wayfare.plans.job import RecommendationRun, run_recommendation_job, stand_in_recommendations  # noqa: F401
from wayfare.plans.inspect import physical_plan, plan_contains  # noqa: F401
