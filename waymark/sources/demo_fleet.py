"""The demonstration fleet."""

# Zones, routes and vehicles of the demonstration.
DEMO = {
    "zones": [
        {"zone_id": "Z-DEPOT-N", "name": "Northbridge Depot", "zone_kind": "depot", "max_dwell_minutes": 90, "boundary": [[104.884, 11.584], [104.896, 11.584], [104.896, 11.596], [104.884, 11.596], [104.884, 11.584]]},
        {"zone_id": "Z-DEPOT-S", "name": "Chak Angre Depot", "zone_kind": "depot", "max_dwell_minutes": 90, "boundary": [[104.924, 11.504], [104.936, 11.504], [104.936, 11.516], [104.924, 11.516], [104.924, 11.504]]},
        {"zone_id": "Z-CUST-RIVERSIDE", "name": "Riverside Retail", "zone_kind": "customer", "max_dwell_minutes": 20, "boundary": [[104.9275, 11.5655], [104.9365, 11.5655], [104.9365, 11.5745], [104.9275, 11.5745], [104.9275, 11.5655]]},
        {"zone_id": "Z-CUST-OLYMPIC", "name": "Olympic Market", "zone_kind": "customer", "max_dwell_minutes": 20, "boundary": [[104.9135, 11.5455], [104.9225, 11.5455], [104.9225, 11.5545], [104.9135, 11.5545], [104.9135, 11.5455]]},
        {"zone_id": "Z-CUST-TOULKORK", "name": "Toul Kork Distribution", "zone_kind": "customer", "max_dwell_minutes": 20, "boundary": [[104.8905, 11.5705], [104.8995, 11.5705], [104.8995, 11.5795], [104.8905, 11.5795], [104.8905, 11.5705]]},
        {"zone_id": "Z-CUST-AIRPORT", "name": "Airport Cargo Terminal", "zone_kind": "customer", "max_dwell_minutes": 45, "boundary": [[104.8395, 11.5405], [104.8505, 11.5405], [104.8505, 11.5515], [104.8395, 11.5515], [104.8395, 11.5405]]},
        {"zone_id": "Z-REST-PALACE", "name": "Palace Precinct (no goods vehicles)", "zone_kind": "restricted", "max_dwell_minutes": None, "boundary": [[104.928, 11.558], [104.934, 11.558], [104.934, 11.564], [104.928, 11.564], [104.928, 11.558]]},
        {"zone_id": "Z-CONG-MONIVONG", "name": "Monivong Boulevard Corridor", "zone_kind": "congestion", "max_dwell_minutes": None, "boundary": [[104.9155, 11.542], [104.9205, 11.542], [104.9205, 11.578], [104.9155, 11.578], [104.9155, 11.542]]},
    ],
    "routes": [
        {"route_id": "R-NORTH-LOOP", "name": "North Loop", "start_zone_id": "Z-DEPOT-N", "end_zone_id": "Z-DEPOT-N", "planned_duration_minutes": 75, "service_minutes": 8, "stop_zone_ids": ["Z-CUST-TOULKORK", "Z-CUST-RIVERSIDE"], "path": [[104.89, 11.59], [104.892, 11.585], [104.895, 11.579], [104.895, 11.575], [104.902, 11.573], [104.911, 11.572], [104.918, 11.5715], [104.926, 11.5705], [104.932, 11.57], [104.93, 11.578], [104.92, 11.585], [104.905, 11.589], [104.89, 11.59]]},
        {"route_id": "R-SOUTH-RUN", "name": "South Run", "start_zone_id": "Z-DEPOT-S", "end_zone_id": "Z-DEPOT-S", "planned_duration_minutes": 60, "service_minutes": 8, "stop_zone_ids": ["Z-CUST-OLYMPIC", "Z-CUST-RIVERSIDE"], "path": [[104.93, 11.51], [104.928, 11.52], [104.925, 11.532], [104.921, 11.543], [104.918, 11.55], [104.922, 11.558], [104.928, 11.565], [104.932, 11.57], [104.935, 11.56], [104.936, 11.545], [104.934, 11.53], [104.93, 11.51]]},
        {"route_id": "R-AIRPORT-SHUTTLE", "name": "Airport Shuttle", "start_zone_id": "Z-DEPOT-N", "end_zone_id": "Z-DEPOT-N", "planned_duration_minutes": 90, "service_minutes": 20, "stop_zone_ids": ["Z-CUST-AIRPORT"], "path": [[104.89, 11.59], [104.885, 11.58], [104.88, 11.57], [104.87, 11.562], [104.858, 11.554], [104.845, 11.546], [104.852, 11.556], [104.865, 11.568], [104.878, 11.579], [104.89, 11.59]]},
        {"route_id": "R-CITY-CROSS", "name": "City Cross", "start_zone_id": "Z-DEPOT-S", "end_zone_id": "Z-DEPOT-N", "planned_duration_minutes": 70, "service_minutes": 8, "stop_zone_ids": ["Z-CUST-OLYMPIC", "Z-CUST-TOULKORK"], "path": [[104.93, 11.51], [104.926, 11.525], [104.922, 11.54], [104.918, 11.55], [104.9175, 11.56], [104.917, 11.57], [104.908, 11.573], [104.895, 11.575], [104.893, 11.582], [104.89, 11.59]]},
    ],
    "vehicles": [
        {"vehicle_id": "VH-001", "plate": "PP-1201", "vehicle_type": "van", "capacity_kg": 1200, "home_depot_id": "Z-DEPOT-N"},
        {"vehicle_id": "VH-002", "plate": "PP-1202", "vehicle_type": "van", "capacity_kg": 1200, "home_depot_id": "Z-DEPOT-N"},
        {"vehicle_id": "VH-003", "plate": "PP-1203", "vehicle_type": "van", "capacity_kg": 1200, "home_depot_id": "Z-DEPOT-S"},
        {"vehicle_id": "VH-004", "plate": "PP-1204", "vehicle_type": "van", "capacity_kg": 1500, "home_depot_id": "Z-DEPOT-S"},
        {"vehicle_id": "VH-005", "plate": "PP-1205", "vehicle_type": "van", "capacity_kg": 1500, "home_depot_id": "Z-DEPOT-N"},
        {"vehicle_id": "VH-006", "plate": "PP-3301", "vehicle_type": "truck", "capacity_kg": 4500, "home_depot_id": "Z-DEPOT-N"},
        {"vehicle_id": "VH-007", "plate": "PP-3302", "vehicle_type": "truck", "capacity_kg": 4500, "home_depot_id": "Z-DEPOT-S"},
        {"vehicle_id": "VH-008", "plate": "PP-3303", "vehicle_type": "truck", "capacity_kg": 7500, "home_depot_id": "Z-DEPOT-S"},
        {"vehicle_id": "VH-009", "plate": "PP-3304", "vehicle_type": "truck", "capacity_kg": 7500, "home_depot_id": "Z-DEPOT-N"},
        {"vehicle_id": "VH-010", "plate": "PP-8801", "vehicle_type": "motorbike", "capacity_kg": 60, "home_depot_id": "Z-DEPOT-S"},
        {"vehicle_id": "VH-011", "plate": "PP-8802", "vehicle_type": "motorbike", "capacity_kg": 60, "home_depot_id": "Z-DEPOT-N"},
        {"vehicle_id": "VH-012", "plate": "PP-8803", "vehicle_type": "motorbike", "capacity_kg": 60, "home_depot_id": "Z-DEPOT-S"},
    ],
}
