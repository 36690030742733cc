"""Named datasets: staging views, conformed entities, reporting marts."""
