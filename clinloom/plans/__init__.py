"""Models: staging, intermediate, marts, reports, rules and jobs."""
