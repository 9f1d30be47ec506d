"""Business plans: staging, eligibility, marts, DQ gates, run log."""
