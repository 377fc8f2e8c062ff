"""Where events come from: landed snapshots, the topic, stored tables, generators."""
