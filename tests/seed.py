"""Seven sample documents (fixed values) and edge-case helpers."""

from __future__ import annotations

import json
import os

# The sample documents of each collection.
SEED = {
    "UserSessions": [
        {
            "session_id": "sess_001",
            "user_id": "user_123",
            "start_time": "2024-01-10T09:00:00Z",
            "end_time": "2024-01-10T09:30:00Z",
            "pages_visited": ["/home", "/products", "/products/42", "/cart"],
            "device": "mobile",
            "actions": ["login", "view_product", "add_to_cart", "logout"],
        },
        {
            "session_id": "sess_002",
            "user_id": "user_456",
            "start_time": "2024-01-10T10:15:00Z",
            "end_time": "2024-01-10T10:45:00Z",
            "pages_visited": ["/home", "/about", "/contact"],
            "device": "desktop",
            "actions": ["login", "view_page", "logout"],
        },
    ],
    "EventLogs": [
        {
            "event_id": "evt_1001",
            "timestamp": "2024-01-10T09:05:20Z",
            "event_type": "click",
            "details": {"page": "/products/42"},
        },
        {
            "event_id": "evt_1002",
            "timestamp": "2024-01-10T09:06:15Z",
            "event_type": "scroll",
            "details": {"page": "/products/42"},
        },
    ],
    "SupportTickets": [
        {
            "ticket_id": "ticket_789",
            "user_id": "user_123",
            "status": "open",
            "issue_type": "payment",
            "messages": [
                {"sender": "user", "message": "Не могу оплатить заказ.", "timestamp": "2024-01-09T12:00:00Z"}
            ],
            "created_at": "2024-01-09T11:55:00Z",
            "updated_at": "2024-01-09T13:00:00Z",
        }
    ],
    "UserRecommendations": [
        {
            "user_id": "user_123",
            "recommended_products": ["prod_101", "prod_205", "prod_333"],
            "last_updated": "2024-01-10T08:00:00Z",
        }
    ],
    "ModerationQueue": [
        {
            "review_id": "rev_555",
            "user_id": "user_123",
            "product_id": "prod_101",
            "review_text": "Отличный товар!",
            "rating": 5,
            "moderation_status": "pending",
            "flags": ["contains_images"],
            "submitted_at": "2024-01-08T10:20:00Z",
        }
    ],
}


def write_collections(root, collections=None) -> str:
    """JSON Lines files, one per collection; the stored ``_id`` is part of each document."""
    os.makedirs(str(root), exist_ok=True)
    for name, documents in (collections or SEED).items():
        with open(os.path.join(str(root), f"{name}.jsonl"), "w", encoding="utf-8") as out:
            for number, document in enumerate(documents):
                line = document
                if not isinstance(line, str):
                    line = json.dumps({"_id": {"$oid": f"{number:024x}"}, **document})
                out.write(line + "\n")
    return str(root)
